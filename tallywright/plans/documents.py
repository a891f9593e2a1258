"""The document side of a statement run: grouped exports, statement packs, file names, dispatch and batches."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallywright.functions import dates, filters, text
from tallywright.functions.money import dollars
from tallywright.operators.numbering import batch_numbers, first_in_group, number_rows, occurrence_count
from tallywright.operators.reshape import column_widths
from tallywright.sources.staging import staged
from tallywright.plans.statements import FAILED, Platform, covered_payouts, monthly_charges, payout_statement, summary_statement

MARKER = "n/a"


def workbook_rows(df: DataFrame, number_columns: Sequence[str], marker: str = MARKER) -> DataFrame:
    """All columns but the numbers as text, with the marker for null and blank; numbers keep their nulls."""
    return df.select(
        *[F.col(c) if c in number_columns else text.blank_to(F.col(c).cast("string"), marker).alias(c) for c in df.columns]
    )


def workbook_sheets(
    df: DataFrame, group_column: str, number_columns: Sequence[str], order_by: Sequence[str], marker: str = MARKER
) -> DataFrame:
    """The workbooks the rows are split into: `workbook` (the group; the marker for rows without one), `row_no` from 2, below
    the headings, and the other columns as the export shows them. A large group is numbered over many tasks."""
    shown = workbook_rows(df, number_columns, marker).withColumnRenamed(group_column, "workbook")
    return number_rows(shown, order_by, ["workbook"], "row_no").withColumn("row_no", F.col("row_no") + 1)


def workbook_widths(
    df: DataFrame, group_column: str, number_columns: Sequence[str], marker: str = MARKER
) -> DataFrame:
    """Column widths per group as the export shows them: missing numbers take the width of the marker."""
    shown = workbook_rows(df, number_columns, marker)
    shown = shown.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit(marker)).alias(c) for c in shown.columns]
    )
    return column_widths(shown, [group_column], [c for c in shown.columns if c != group_column])


@dataclass(frozen=True)
class Section:
    """One sheet of a statement: its rows, their order, whether merchant id and name stay in it, and whether its rows are known
    to be of the pack's merchants only."""

    title: str
    rows: DataFrame
    order_by: Sequence[str]
    keep_ids: bool = False
    of_pack: bool = False


# The letterhead, and the sheet rows on which title, headings and data start.
LETTERHEAD = (
    "Company Name Here",
    "Company Address Here",
    "City, State, ZIP Code",
    "+1 XXX-XXX-XXXX",
    "Statement Period: MM-DD-YYYY to MM-DD-YYYY",
)
TITLE_ROW, HEADING_ROW, FIRST_DATA_ROW = 7, 9, 10
CELL_SEPARATOR = "\t"


def cell(value: Column, kind: T.DataType) -> Column:
    """A value as one cell of a line: null is empty, floating-point money has two decimals, and a backslash, tab or line
    break within a text is written as \\\\, \\t, \\n or \\r, so that it can't shift cells."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value.cast("decimal(38,2)")
    shown = F.coalesce(value.cast("string"), F.lit(""))
    if isinstance(kind, T.StringType):
        for raw, written in (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")):
            shown = F.replace(shown, F.lit(raw), F.lit(written))
    return shown


# Order columns of sections are of different types; each type has a column of its own in the union of all sections.
ORDER_KINDS = (
    (T.IntegralType, "bigint"),
    (T.DecimalType, "decimal(38,6)"),
    (T.FractionalType, "double"),
    ((T.DateType, T.TimestampNTZType, T.TimestampType), "timestamp_ntz"),
    (T.DataType, "string"),
)


def _ordered(section: Section) -> dict[str, Column]:
    """The section's order columns under names that tell place and type."""
    found = {}
    for place, column in enumerate(section.order_by):
        kind = next(cast for family, cast in ORDER_KINDS if isinstance(section.rows.schema[column].dataType, family))
        found[f"_{place}_{kind.partition('(')[0]}"] = F.col(column).cast(kind)
    return found


def pack_merchants(first: DataFrame, targets: DataFrame | None = None, id_column: str = "merchant_id") -> DataFrame:
    """The merchants of a pack: those of its first section, or the targets among them."""
    merchants = first.select(id_column).filter(F.col(id_column).isNotNull()).distinct()
    return merchants if targets is None else merchants.join(targets.select(id_column), id_column, "left_semi")


def statement_pack(
    sections: Sequence[Section],
    targets: DataFrame | None = None,
    letterhead: Sequence[str] = LETTERHEAD,
    id_column: str = "merchant_id",
    name_column: str = "merchant_name",
    stage: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Statement sheets as lines: (merchant, sheet number, sheet, row, line), cells parted by tabs.

    Every merchant of the first section gets all sheets, even empty ones. The rows of all sheets are numbered in one pass.
    A statement stays a set of rows and is never gathered into one value, so a merchant with very many lines is spread over
    tasks like any other rows. `targets` limits the run to the merchants in its id column. Numbering reads the rows three
    times; `stage` may write them once and return what was written.
    """
    first = sections[0].rows
    filters.require_columns(first, [id_column, name_column])
    merchants = pack_merchants(first, targets, id_column)
    top, bodies, order = [], [], {}
    for number, section in enumerate(sections, start=1):
        hidden = () if section.keep_ids else (id_column, name_column)
        shown = [c for c in section.rows.columns if c not in hidden]
        lines = [*enumerate(letterhead, start=1), (TITLE_ROW, section.title), (HEADING_ROW, CELL_SEPARATOR.join(shown))]
        top += [
            F.struct(F.lit(number).alias("section_no"), F.lit(section.title).alias("section"), F.lit(i).cast("long").alias("row_no"), F.lit(t).alias("line"))
            for i, t in lines
        ]
        cells = [cell(F.col(c), section.rows.schema[c].dataType) for c in shown]
        keys = _ordered(section)
        order |= dict.fromkeys(sorted(keys))
        of_pack = section.rows if section.of_pack else section.rows.join(merchants, id_column, "left_semi")
        bodies.append(
            of_pack.select(
                id_column,
                F.lit(number).alias("section_no"),
                F.concat_ws(CELL_SEPARATOR, *cells).alias("line"),
                *[value.alias(name) for name, value in keys.items()],
            )
        )
    heads = merchants.select(id_column, F.explode(F.array(*top)).alias("_top")).select(id_column, "_top.*")
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), bodies)
    body = number_rows(stage(rows), sorted(order), [id_column, "section_no"], "_place", ties_by=["line"])
    row_no = (F.col("_place") + (FIRST_DATA_ROW - 1)).cast("long").alias("row_no")
    title = F.element_at(F.array(*[F.lit(section.title) for section in sections]), F.col("section_no")).alias("section")
    return heads.unionByName(body.select(id_column, "section_no", title, row_no, "line"))


def statement_file_names(
    account_info: DataFrame,
    targets: DataFrame | None = None,
    id_column: str = "merchant_id",
    name_column: str = "merchant_name",
    id_pattern: str = "^mer_[a-zA-Z0-9]+$",
) -> DataFrame:
    """One file name per merchant: `Name_Statement`, with the id between when the name is not unique.

    The name loses characters that file systems forbid; ids outside the pattern always keep the long form. Of several
    names of one merchant the first in order counts.
    """
    chosen = account_info.filter(F.col(id_column).isNotNull())
    if targets is not None:
        chosen = chosen.join(targets.select(id_column).distinct(), id_column, "left_semi")
    named = chosen.groupBy(id_column).agg(text.safe_file_name(F.min(name_column)).alias("file_base"))
    counted = occurrence_count(named, "file_base", "merchants_of_name")
    short = (F.col("merchants_of_name") == 1) & F.col(id_column).rlike(id_pattern)
    long_name = F.concat("file_base", F.lit("_"), F.col(id_column), F.lit("_Statement"))
    return counted.select(
        id_column,
        "file_base",
        "merchants_of_name",
        F.when(short, F.concat("file_base", F.lit("_Statement"))).otherwise(long_name).alias("file_name"),
    )


@dataclass(frozen=True)
class DivisionMail:
    """Mail settings of a division; the number of divisions is that of the configuration, so they are literals."""

    subject: str
    sender: str
    bcc: str = ""
    send: bool = False


@dataclass(frozen=True)
class DispatchConfig:
    """Mail settings by division, and the text that follows the salutation."""

    body: str
    divisions: Mapping[str, DivisionMail] = field(default_factory=dict)


def division_setting(config: DispatchConfig, division: Column, attribute: str) -> Column:
    pairs = [F.lit(x) for name, mail in config.divisions.items() for x in (name.strip().lower(), getattr(mail, attribute))]
    return F.try_element_at(F.create_map(*pairs), division)


def valid_recipients(recipients: DataFrame, config: DispatchConfig, attachments: DataFrame) -> DataFrame:
    """Recipients of a configured division whose attachment exists and whose salutation names the attached file."""
    division = F.lower(F.trim("division"))
    known = [name.strip().lower() for name in config.divisions]
    greeting = F.replace(F.element_at(F.split("salutation", ","), 1), F.lit("Dear "), F.lit(""))
    file_name = text.clean_string(text.base_name(F.col("attachment_path")))
    existing = attachments.select(F.col("path").alias("attachment_path"))
    return (
        recipients.withColumn("division", division)
        .filter(F.col("division").isin(known))
        .filter(F.contains(file_name, text.clean_string(greeting)))
        .join(existing, "attachment_path", "left_semi")
    )


def dispatch_manifest(
    recipients: DataFrame,
    config: DispatchConfig,
    attachments: DataFrame,
    today: Column | None = None,
    order_by: Sequence[str] = ("sheet_row",),
) -> DataFrame:
    """What to send to whom: subject with last month's tag, sender, body, and whether it is sent or saved as draft.

    The first recipient of each division is flagged as the draft to review.
    """
    day = F.current_date() if today is None else today
    valid = valid_recipients(recipients, config, attachments)
    flagged = first_in_group(valid, ["division"], order_by, "is_review_draft")
    division = F.col("division")
    send = division_setting(config, division, "send")
    tag = dates.previous_month_tag(day)
    return flagged.select(
        *order_by,
        "merchant_id",
        F.col("email").alias("recipient"),
        "division",
        F.concat(division_setting(config, division, "subject"), F.lit(" "), tag).alias("subject"),
        division_setting(config, division, "sender").alias("sender"),
        F.nullif(division_setting(config, division, "bcc"), F.lit("")).alias("bcc"),
        F.trim(F.concat("salutation", F.lit("\n\n" + config.body))).alias("body"),
        "attachment_path",
        "is_review_draft",
        F.when(send, F.lit("send")).otherwise(F.lit("draft")).alias("action"),
    )


def dispatch_totals(manifest: DataFrame) -> DataFrame:
    """Mails per division and action."""
    return manifest.groupBy("division", "action").agg(F.count(F.lit(1)).alias("mails"))


@dataclass(frozen=True)
class BatchSettings:
    """Batch size and the two waits, in minutes."""

    size: int = 10
    snapshot_wait: float = 4.0
    update_wait: float = 0.5


def statement_batches(
    merchants: DataFrame,
    period_start: dt.date,
    period_end: dt.date,
    settings: BatchSettings = BatchSettings(),
    id_column: str = "merchant_id",
) -> DataFrame:
    """Batches of merchants in id order, each with its period and size; a batch holds at most `size` ids."""
    batched = batch_numbers(merchants.select(id_column), [id_column], settings.size)
    return batched.groupBy("batch_no").agg(
        F.array_join(F.sort_array(F.collect_list(id_column)), ",").alias("merchants"),
        F.count(F.lit(1)).alias("merchant_count"),
        F.lit(period_start).alias("period_start"),
        F.lit(period_end).alias("period_end"),
    )


@dataclass(frozen=True)
class StatementRun:
    """What a run of monthly statements makes: pack lines, a file name per merchant, the dispatch and the batches."""

    pack: DataFrame
    files: DataFrame
    manifest: DataFrame
    batches: DataFrame


def statement_sections(
    p: Platform, account_info: DataFrame, targets: DataFrame | None = None, stage: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> list[Section]:
    """The five sheets of a merchant's statement from the statement reports. Three of them are added up from the same rows,
    payouts beside the fee payouts that cover them; `stage` may write those once and return what was written."""
    covered = stage(covered_payouts(p, with_charges=True))
    summary = summary_statement(p, covered, pack_merchants(account_info, targets)).drop("division_name", "division_id")
    deposits = payout_statement(p, covered).drop("division_name", "division_id")
    fees = p.fee_payout.filter(F.col("status") != FAILED).select("merchant_id", F.col("id").alias("fee_payout"), "created_at", dollars(F.col("amount")).alias("amount"))
    charges = monthly_charges(p, covered).select("merchant_id", "statement_year", "statement_month_sort", "mfp_created_at", "total_charges")
    return [
        Section("Account Info", account_info, ["merchant_id", "merchant_name"], keep_ids=True),
        Section("Summary", summary, ["mfp_created_at", "mp_id"], of_pack=True),
        Section("Deposit Detail", deposits, ["mp_created_at", "mp_id", "mfp_created_at"]),
        Section("Platform Fees", fees, ["created_at", "fee_payout"]),
        Section("Charges", charges, ["mfp_created_at"]),
    ]


def statement_run(
    p: Platform,
    account_info: DataFrame,
    recipients: DataFrame,
    config: DispatchConfig,
    folder: str,
    period_start: dt.date,
    period_end: dt.date,
    staging_path: str,
    run_id: str,
    targets: DataFrame | None = None,
    today: Column | None = None,
    settings: BatchSettings = BatchSettings(),
) -> StatementRun:
    """A whole run: the statement reports become the packs' sheets, each pack gets its file name, and the files of this run
    are the attachments of its mails. `folder` is where the documents will stand; a recipient's own path is not used. The
    rows of all sheets, and those that three of the sheets are added up from, are worked out once, now, and staged under the
    run's id."""
    sections = statement_sections(p, account_info, targets, stage=lambda rows: staged(rows, f"{staging_path}-payouts", run_id))
    pack = statement_pack(sections, targets, stage=lambda rows: staged(rows, staging_path, run_id))
    files = run_files(account_info, folder, targets, settings)
    manifest = run_manifest(recipients, config, files, today)
    batches = statement_batches(files, period_start, period_end, settings)
    return StatementRun(pack, files, manifest, batches)


def run_files(account_info: DataFrame, folder: str, targets: DataFrame | None = None, settings: BatchSettings = BatchSettings()) -> DataFrame:
    """The file name, path and batch of each merchant of a run."""
    path = F.concat(F.lit(folder.rstrip("/") + "/"), "file_name", F.lit(".pdf"))
    names = statement_file_names(account_info, targets).select("merchant_id", "file_name", path.alias("path"))
    return batch_numbers(names, ["merchant_id"], settings.size)


def run_manifest(recipients: DataFrame, config: DispatchConfig, files: DataFrame, today: Column | None = None) -> DataFrame:
    """The dispatch of a run: each recipient gets the file of their merchant."""
    paths = files.select("merchant_id", F.col("path").alias("attachment_path"))
    addressed = recipients.drop("attachment_path").join(paths, "merchant_id")
    return dispatch_manifest(addressed, config, files.select("path"), today)


def run_estimate(merchants: DataFrame, settings: BatchSettings = BatchSettings()) -> DataFrame:
    """Merchants, batches and the minutes the waits of a run add up to, rounded up."""
    batches = F.ceil(F.col("merchant_count") / settings.size)
    minutes = F.ceil(batches * (settings.snapshot_wait + settings.update_wait))
    return merchants.agg(F.count(F.lit(1)).alias("merchant_count")).select(
        "merchant_count", batches.alias("batch_count"), minutes.alias("estimated_minutes")
    )


def address_timezones(addresses: DataFrame, zones: DataFrame, key: str = "place_key") -> DataFrame:
    """Time zone per address from a lookup, with the report line; addresses without one get a fallback line."""
    found = addresses.join(zones.select(key, "time_zone"), key, "left")
    line = F.when(
        F.coalesce("time_zone", F.lit("")) != "", F.format_string("Timezone for %s: %s", "Address", "time_zone")
    ).otherwise(F.format_string("No timezone data found for %s", "Address"))
    return found.select("Address", "time_zone", line.alias("line"))
