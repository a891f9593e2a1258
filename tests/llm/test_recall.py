"""Recall and precision of the rare label on held-out rows, which a model that always gives the other label does not reach."""

import pytest

from tallywright.llm.queries import QUERIES


@pytest.mark.parametrize(
    "name, label, rare, recall, precision",
    [("op4_factorisation_machine", "quality", 0, 0.95, 0.95), ("op5_ftrl_toxicity", "toxic", 1, 0.75, 0.95)],
)
def test_rare_label(spark, name, label, rare, recall, precision):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(f"{label} is not null")
    rows = QUERIES[name](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    found = sum(r.predicted == rare for r in rows)
    right = sum(r.predicted == rare == r[label] for r in rows)
    assert right >= recall * sum(r[label] == rare for r in rows) > 0
    assert right >= precision * found > 0
