"""Logical tables of the reports, derived from the driver's tables by SQL that Spark and DuckDB both read."""

from __future__ import annotations

import hashlib
import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallywright.operators.packing import day_and_span, day_number, folded, of_day, packed, parts, unfolded, unpacked
from tallywright.sources.tables import read_table, table_names

VIEWS: dict[str, str] = {
    "entity": """
        select concat('div_',r_regionkey) id, r_name name, 2 entity_type, nullif('x','x') parent_entity_id from region
        union all select concat('grp_',n_nationkey), n_name, 3, concat('div_',n_regionkey) from nation
        union all select distinct concat('app_',c_nationkey,'_',c_mktsegment), concat(c_mktsegment,' ',c_nationkey), 4, concat('grp_',c_nationkey) from customer
        union all select concat('mer_',c_custkey), c_name, 5, concat('app_',c_nationkey,'_',c_mktsegment) from customer
    """,
    "payment_intent": """
        select concat('pi_',o_orderkey) id, concat('con_',o_custkey) contract_id,
        case o_orderpriority when '1-URGENT' then 'CREDIT_CARD' when '2-HIGH' then 'DEBIT_CARD' when '3-MEDIUM' then 'BANK_ACCOUNT' else 'OTHER' end payment_method_type,
        case when o_orderpriority in ('1-URGENT','2-HIGH') then case o_orderkey % 4 when 0 then 'VISA' when 1 then 'MASTERCARD' when 2 then 'AMERICAN_EXPRESS' else 'DISCOVER' end end card_brand,
        case when o_orderpriority='3-MEDIUM' then 'CHECKING' end bank_account_type from orders
    """,
    "txn": """
        select concat('txn_',l_orderkey,'_',l_linenumber) as id, concat('mer_',o_custkey) as merchant_id, concat('pi_',l_orderkey) as payment_intent_id, concat('pm_',o_custkey % 97) as payment_method_id, concat('MID',100000+o_custkey) as mid,
        min(l_shipdate) as created_at, min(l_shipdate)+interval 2 day as settled_at, min(l_shipdate)+interval 3 day as funded_at, 'USD' as currency,
        cast(sum(cast(round(l_extendedprice*100) as bigint)) as bigint) as amount, cast(sum(cast(round(l_quantity) as bigint)*30) as bigint) as merchant_fee, cast(sum(cast(round(l_quantity) as bigint)*10) as bigint) as buyer_fee,
        case min(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end) when 3 then 'REVERSAL' when 1 then 'CREDIT' else 'DEBIT' end as type, case min(case l_linestatus when 'F' then 0 else 1 end) when 0 then 'SETTLED' else 'PENDING' end as status, case l_linenumber % 3 when 0 then 'BANK_ACCOUNT' else 'CREDIT_CARD' end as payment_method_type,
        case min(case l_linestatus when 'F' then 0 else 1 end) when 0 then 'FUNDED' else 'UNFUNDED' end as funding_status, cast(l_linenumber % 2 as int) as can_be_paid, concat('net_',l_orderkey) as network_transaction_id, case min(case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end) when 3 then concat('txn_',l_orderkey,'_1') end as original_transaction_id
        from lineitem join orders on l_orderkey=o_orderkey group by l_orderkey,l_linenumber,o_custkey
    """,
    "merchant_payout": """
        select concat('mp_',o_orderkey) id, o_orderdate+interval 1 day created_at, cast(round(o_totalprice*100) as bigint) gross_amount,
        case o_orderstatus when 'F' then 'GROSS' when 'O' then 'NET' else 'OTHER' end funding_type from orders
    """,
    "mpt": """
        select concat('mp_',l_orderkey) merchant_payout_id, concat('txn_',l_orderkey,'_',l_linenumber) transaction_id from (select distinct l_orderkey, l_linenumber from lineitem) q
    """,
    "mfp": """
        select concat('mfp_',o_custkey,'_',ym) as id, concat('mer_',o_custkey) as merchant_id, cast(make_date(y,mo,1) as timestamp) + interval 1 month as created_at,
        case when (o_custkey+ym) % 11 = 0 then 'FAILED' else 'PAID' end as status, cast(n*1000 as bigint) as amount
        from (select o_custkey, y, mo, y*100+mo as ym, n from (select o_custkey, year(o_orderdate) as y, month(o_orderdate) as mo, count(*) as n from orders group by 1,2,3) p) q
    """,
    "mfpmp": """
        select concat('mfp_',o_custkey,'_',year(o_orderdate)*100+month(o_orderdate)) merchant_fee_payout_id, concat('mp_',o_orderkey) merchant_payout_id from orders
    """,
    "charge": """
        select concat('chg_',event_id) id, concat('mer_',user_id) entity_id, concat('Charge ',event_type) description, cast(round(value*100) as bigint) amount, event_type type, 'FUNDED' funding_status, ts created_at, ts + interval 1 day funded_at from events
    """,
    "mpc": """
        select concat('mp_',k) merchant_payout_id, concat('chg_',event_id) charge_id from events join (select o_custkey, min(o_orderkey) k from orders group by 1) q on user_id=o_custkey
    """,
    "fee_profile": """
        select concat('fp_',c_custkey) id, date '2024-01-01' start_date, nullif(date '2024-12-31',date '2024-12-31') end_date,
        concat('{"defaultAchFees":{"buyerPct":"',c_custkey % 5,'.25","merchantPct":"1.10","buyerFixedFee":"0.30"},"disputeFixedFee":"15","networkSpecificFees":',
        case c_custkey % 3 when 0 then '{}' when 1 then '{"Visa":{"buyerPct":"2.5","interChangePlus":"true"}}' else '{"American Express":{"buyerPct":"3.5","merchantPct":"n/a"},"Visa":{"buyerPct":"1"}}' end,'}') configuration from customer where c_custkey % 40 <> 0
    """,
    "ledger_transaction": """
        select concat('mer_',o_custkey) merchant_entity_id, cast(l_shipdate as date) activity_date, cast(l_extendedprice as decimal(18,2)) settlement_amount, cast(l_quantity*0.25 as decimal(18,2)) interchange_amount,
        case l_linestatus when 'F' then 'true' else 'false' end card_present, case l_returnflag when 'R' then 'REVERS' when 'A' then 'CREDIT' else 'DEBIT' end transaction_type, cast(l_quantity*0.5 as decimal(18,2)) merchant_fee, cast(l_quantity*0.125 as decimal(18,3)) buyer_fee from lineitem join orders on l_orderkey=o_orderkey
    """,
    "merchant_fee": """
        select concat('mer_',o_custkey) merchant_entity_id, cast(o_orderdate as date) statement_date, case when o_orderpriority in ('1-URGENT','2-HIGH') then 'PayFac Monthly' else 'Core Monthly' end source, cast((o_orderkey % 400)*0.25 as decimal(18,2)) amount, cast(o_orderkey % 7 as int) fee_category from orders
    """,
    "fee_lines": """
        select cast(year(l_shipdate)*100+month(l_shipdate) as int) as Month, concat('club_',l_suppkey) as CLUB, cast(l_suppkey % 2 as int) as isXPO,
        case p_type when 'ECONOMY' then 'Visa' when 'LARGE' then 'MasterCard' when 'MEDIUM' then 'Discover' when 'PROMO' then 'American Express' when 'SMALL' then 'Electronic Check' else 'Not Applicable' end as Payment_Type,
        case when l_linenumber % 2 = 0 then 'Vantiv Fees' else 'Network Fees' end as Fee_Category_Type,
        case p_size % 6 when 0 then 'Assessments' when 1 then 'Authorizations' when 2 then 'Credit Interchange' when 3 then 'Revenue Solutions' when 4 then 'Payments Acceptance' else 'Other' end as Fee_Category,
        case when p_size % 5 = 0 then 'Chargebacks/Returns' else 'Processing' end as Fee_Sub_Category,
        concat(case p_partkey % 5 when 0 then 'DEBIT ' when 1 then 'DEBIT Regulated ' when 2 then 'INT AMEX OptBlue ' when 3 then 'AVS ' else '' end, p_name) as Description,
        case when l_suppkey % 3 = 0 then 'REPORTING_GROUP_X' else 'REPORTING_GROUP_Y' end as reporting_group,
        concat(cast(round(l_quantity) as bigint),'.25') as Total_Fees, concat(l_linenumber,'') as Txn_Count, concat(cast(round(l_extendedprice) as bigint),'.50') as Txn_Amount from lineitem join part on l_partkey=p_partkey
    """,
    "stores": """
        select s_suppkey StoreID, case when s_suppkey % 10 <> 9 then s_nationkey end ChainID, element_status Status, case when s_suppkey % 17 = 3 then 1 else 0 end Deleted, cast(s_suppkey % 3 as int) CollectionsBy, concat('EXT',s_suppkey) ExternalStoreID from (select *, case s_suppkey % 5 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 7 else 9 end element_status from supplier) q
    """,
    "settlement_log": """
        select sid*1000000+ym as SettlementLogId, sid as CoreId, 3 as CoreTypeId, sid*1000000+ym as ReconcileId, make_date(y,mo,1) as FromDate, last_day(make_date(y,mo,1)) as ToDate,
        q as UpFront_PilTotal_Total, case when n % 4 <> 0 then q*2 end as Draft_PilTotal_Total, q*3 as Product_PilTotal_Total, n*7 as Pdc_PilTotal_Total, n*5 as PdcDirect_PilTotal_Total, 0-n*11 as Refund_RefundTotal_Total, 0-n*13 as Return_PaymentTotal_Total, q*5 as Net_Total, n*17 as SalesTax_Total, q*5+n*17 as Total_AfterTax,
        q as Draft_PilTotal_Vmd, n as Draft_PilTotal_Amex, n*2 as Draft_PilTotal_Ach, n*3 as Draft_PilTotal_Cash, n*4 as Draft_PilTotal_WrittenCheck, n*6 as Draft_PilTotal_External
        from (select sid, y, mo, y*100+mo as ym, q, n from (select l_suppkey as sid, year(l_shipdate) as y, month(l_shipdate) as mo, cast(sum(cast(round(l_quantity) as bigint)) as bigint) as q, count(*) as n from lineitem group by 1,2,3) x) z
    """,
    "settlement_log_fee": """
        select sid*1000000+ym as SettlementLogId, sid*10+ln as ReconcileFeeId, case ln when 6 then 17 when 7 then 35 when 5 then 4 else 3 end as FeeCategoryId,
        case ln when 1 then 'Heart Monitor' when 2 then 'Corp Email' when 3 then 'Digital Marketing Service' when 4 then 'Emma' when 5 then 'Software Fee' when 6 then 'PCI Compliance' else 'CR Connect' end as FeeName, cast(n*5 as bigint) as Amount
        from (select l_suppkey as sid, year(l_shipdate)*100+month(l_shipdate) as ym, l_linenumber as ln, count(*) as n from lineitem group by 1,2,3) z
    """,
    "remit_adjustments": """
        select sid as StoreId, sid as CoreId, 3 as CoreTypeId, k as AdjustmentNo, amt as Amount, case when k % 3 = 0 then 1 else 0 end as Accrual, case when k % 7 = 1 then 4 else 1 end as RemitAdjustmentTypeId, case k % 6 when 0 then 85 when 1 then 86 when 2 then 80 when 3 then 81 else 1 end as QuickbookSubcategoryId,
        case when k % 9 <> 8 then sid*1000000+ym end as ReconcileId, sid*1000000+ym as CreatedByReconcileId, case when k % 5 = 0 then 1 else 0 end as Chain, case when k % 4 = 0 then sid*10+ln end as AdjustmentForFeeId
        from (select l_suppkey as sid, year(l_shipdate)*100+month(l_shipdate) as ym, l_linenumber as ln, l_orderkey as k, cast(sum(cast(round(l_quantity) as bigint)) as bigint)*(1-2*(l_orderkey % 2)) as amt from lineitem group by 1,2,3,4) z
    """,
    "payments": """
        select o_orderkey as PaymentID, o_custkey % 100 as StoreID, o_orderdate + interval 20 hour as PaymentDate, case o_orderkey % 3 when 0 then 1 when 1 then 6 else 2 end as PurchaseWith, case o_orderkey % 2 when 0 then 'CP' else 'EC' end as GatewayType,
        case o_orderkey % 6 when 0 then concat('$',o_orderkey % 900,',',100+o_orderkey % 900,'.50') when 1 then concat(o_orderkey % 900,'..75') when 2 then '' when 3 then nullif('x','x') else concat(o_orderkey % 900,'') end as TotalAmount, concat(o_orderkey % 50,'.25') as Amount from orders
    """,
    "contract": """
        select concat('con_',c_custkey) as id, concat('fp_',c_custkey) as fee_profile_id from customer
    """,
    "merchant": """
        select concat('mer_',c_custkey) as id, concat('MID',100000+c_custkey) as mid from customer
    """,
    "merchant_fee_profile": """
        select concat('mer_',c_custkey) as merchant_id, concat('fp_',c_custkey) as fee_profile_id, cast(c_custkey % 2 as int) as is_active from customer where c_custkey % 7 <> 0
    """,
    "general_prefs": """
        select s_suppkey as StoreID, concat(case s_suppkey % 6 when 0 then 'BRAND_A ' when 1 then 'BRAND_D ' when 2 then 'BRAND_R ' when 3 then 'brand_p ' else 'Club ' end, s_name) as LocationName, case s_suppkey % 4 when 0 then 'CA' when 3 then nullif('x','x') else 'US' end as clubcountry, case s_suppkey % 5 when 0 then 'Kentucky' when 1 then 'Texas' when 2 then 'BC' when 3 then '' else 'FL' end as ClubState, concat(s_suppkey,' Main St ') as ClubAddress, 'Town' as ClubCity, concat(10000+s_suppkey,'') as ClubZip, cast(0 - (s_suppkey % 9) as int) as TimeOffset from supplier where s_suppkey % 20 <> 19
    """,
    "chains": """
        select n_nationkey as ChainID, case n_nationkey % 8 when 3 then 'brand_d east' when 5 then 'BRAND_S west' when 6 then concat('Demo ',n_name) else n_name end as ChainName, case when n_nationkey % 9 = 4 then 1 end as Deleted from nation
    """,
    "cas_companies": """
        select r_regionkey as CASCompanyID, r_name as CompanyName, cast(r_regionkey % 2 as int) as IsRemitGroupEnabled from region
    """,
    "cas_clubs": """
        select s_suppkey as CasClubId, s_suppkey as StoreID, cast(s_suppkey % 5 as int) as CasCompanyID, cast(s_suppkey % 2 as int) as IsRemitClubEnabled from supplier where s_suppkey % 4 <> 3
    """,
    "store_info": """
        select s_suppkey as StoreId, cast(s_suppkey % 6 as int) as SiteTypeId from supplier where s_suppkey % 11 <> 10
    """,
    "site_type": """
        select cast(r_regionkey as int) as SiteTypeId, concat('Site ',r_name) as Name from region
    """,
    "reconcile_fee": """
        select sid*10+ln as ReconcileFeeId, sid as CoreId, 3 as CoreTypeId, case ln when 1 then 'Workout System' when 2 then 'Basic WORKOUT system' else concat('Fee ',ln) end as FeeName, cast(ln*100+sid as bigint) as FeeMin, case ln when 6 then 17 when 7 then 35 when 5 then 4 else 3 end as FeeCategoryId, m as StartUtc
        from (select l_suppkey as sid, l_linenumber as ln, min(l_shipdate) as m from lineitem group by 1,2) z
    """,
    "account_info": """
        select concat('mer_',c_custkey) as merchant_id, concat('Shop/',c_mktsegment,' ',c_custkey % 400,'?') as merchant_name from customer
    """,
    "recipients": """
        select concat('mer_',c_custkey) as merchant_id, concat('m',c_custkey,'@example.com') as email, concat('Dear Shop ',c_mktsegment,' ',c_custkey % 400,', hello') as salutation, concat('/out/Shop',case when c_custkey % 6 = 5 then 'X' else '' end,' ',c_mktsegment,' ',c_custkey % 400,'_Statement.pdf') as attachment_path, case c_custkey % 4 when 0 then ' DivA ' when 1 then 'divb' when 2 then 'divC' else 'unknown' end as division, c_custkey + 2 as sheet_row from customer
    """,
    "addresses": """
        select concat(c_custkey,' Main St, NATION_',c_nationkey) as Address, c_nationkey as place_key from customer
    """,
    "address_tz": """
        select n_nationkey as place_key, case n_nationkey % 4 when 0 then 'America/New_York' when 1 then 'Europe/Paris' else 'Asia/Tokyo' end as time_zone from nation where n_nationkey % 6 <> 5
    """,
    "workbook_rows": """
        select case when s_suppkey % 10 = 9 then nullif('x','x') else concat('Group ',s_nationkey) end as group_name, concat('000',s_suppkey) as merchant_id, case s_suppkey % 4 when 0 then '' when 1 then nullif('x','x') else concat('555-',s_suppkey) end as contact_phone, case when s_suppkey % 3 <> 0 then s_acctbal end as annual_sales_volume from supplier
    """,
    "store_status": """
        select distinct Status as StoreStatusId, concat('Status ',Status) as Name from stores
    """,
    "cas_reconcile": """
        select ReconcileId as CasReconcileId, ToDate as Cutoff from settlement_log
    """,
    "fee_category": """
        select distinct FeeCategoryId as FeeCategoryId, case FeeCategoryId when 3 then 'CorporateFee' when 4 then 'SoftwareFee' when 17 then 'PCIFee ' else 'ConnectFee' end as Name from reconcile_fee
    """,
    "store_detail": """
        select StoreID as StoreId, ChainID as ChainId, case when ChainID is not null then concat('Chain ',ChainID) end as ChainName from stores where StoreID % 13 <> 12
    """,
    "attachments": """
        select distinct concat('/out/Shop ',c_mktsegment,' ',c_custkey % 400,'_Statement.pdf') as path from customer where c_custkey % 7 <> 3
        union all select distinct concat('/out/ShopX ',c_mktsegment,' ',c_custkey % 400,'_Statement.pdf') from customer where c_custkey % 6 = 5
    """,
}

#: Tables that a view joins on an order's key and adds up per line at once, with that key. Such a stage sorts both sides and
#: hashes every line twice, which takes several times the bytes it reads, so it is dealt over a number of tasks that follows
#: the input and that adaptive execution does not join together again.
DEALT = {"txn": {"lineitem": "l_orderkey", "orders": "o_orderkey"}}
#: Columns that travel together while rows are dealt: in one number, of so many bits each, amounts as whole cents and times as
#: days; and texts in one. What is no whole cent or needs more bits travels beside it as it is.
FOLDED = {"lineitem": {"l_extendedprice": 31, "l_quantity": 16, "l_shipdate": 16}}
TEXTS = {"lineitem": ("l_returnflag", "l_linestatus")}
#: Tasks of such a stage for each part in which Spark scans the table of the lines.
TASKS_PER_SCAN = 8


@cache
def _needs(name: str) -> tuple[str, ...]:
    """Logical tables a view reads, each after those it reads itself."""
    found: dict[str, None] = {}
    for other in VIEWS:
        if other != name and re.search(rf"(from|join)\s+{other}\b", VIEWS[name]):
            for deeper in (*_needs(other), other):
                found[deeper] = None
    return tuple(found)


def with_clause(names: list[str]) -> str:
    """`name AS (...)` items for the named views and what they need, without the WITH keyword."""
    ordered: dict[str, None] = {}
    for name in names:
        for item in (*_needs(name), name):
            ordered[item] = None
    return ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in ordered)


def views_in(sql: str) -> list[str]:
    return [n for n in VIEWS if re.search(rf"(from|join|,)\s+{n}\b", sql)]


def oracle(sql: str) -> str:
    """Complete a query over logical tables: their definitions go in front of its own WITH items."""
    body = sql.strip()
    definitions = with_clause(views_in(body))
    if not definitions:
        return body
    own = re.match(r"with\s+", body)
    rest = ",\n" + body[own.end() :] if own else "\n" + body
    return f"with {definitions}{rest}"


def _dealt(rows: DataFrame, table: str, tasks: int, key: str) -> DataFrame:
    """The same rows, dealt over the tasks by the key; they are narrower on their way."""
    bits, texts = FOLDED.get(table, {}), TEXTS.get(table, ())
    if not bits:
        return rows.repartition(tasks, key)
    times = [c for c in bits if isinstance(rows.schema[c].dataType, T.TimestampNTZType)]
    cents = {c: F.round(F.col(c) * 100).try_cast("long") for c in bits if c not in times}
    exact = {c: F.coalesce(whole / F.lit(100.0) == F.col(c), F.lit(False)) for c, whole in cents.items()}
    numbers = {f"_n_{c}": F.when(exact[c], whole) for c, whole in cents.items()} | {f"_n_{c}": day_number(c) for c in times}
    widths = {f"_n_{c}": width for c, width in bits.items()}
    beside = {c: F.when(~exact[c], F.col(c)) for c in cents} | {c: of_day(c) for c in times}
    dealt = (
        rows.withColumns(numbers)
        .select(
            *[c for c in rows.columns if c not in (*bits, *texts)],
            *folded(widths, "_folded"),
            *[value.alias(c) for c, value in beside.items()],
            packed([F.col(c) for c in texts]).alias("_texts"),
        )
        .repartition(tasks, key)
    )
    number = unfolded(widths, "_folded")
    found = {c: F.col(c) for c in rows.columns}
    found |= {c: unpacked(parts(F.col("_texts")), n) for n, c in enumerate(texts)}
    found |= {c: F.coalesce(number[f"_n_{c}"] / F.lit(100.0), F.col(c)) for c in cents}
    found |= {c: day_and_span(number[f"_n_{c}"], F.col(c)) for c in times}
    return dealt.select(*[value.alias(c) for c, value in found.items()])


class LogicalTables:
    """The logical tables over one data folder, made on first use."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self.prefix = "src_" + hashlib.sha1(directory.encode()).hexdigest()[:8]
        self._made: dict[str, DataFrame] = {}
        self._registered: set[str] = set()
        self._tasks = 0

    @property
    def tasks(self) -> int:
        """Tasks of a stage that holds the lines in memory; only the scan is planned for it, no job runs."""
        if not self._tasks:
            self._tasks = TASKS_PER_SCAN * max(1, read_table(self.spark, self.directory, "lineitem").rdd.getNumPartitions())
        return self._tasks

    def _register(self, table: str, key: str | None = None) -> str:
        view = f"{self.prefix}_{table}" + (f"_by_{key}" if key else "")
        if view not in self._registered:
            rows = read_table(self.spark, self.directory, table)
            (_dealt(rows, table, self.tasks, key) if key else rows).createOrReplaceTempView(view)
            self._registered.add(view)
        return f"{table} as (select * from {view})"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        if name not in self._made:
            definitions = with_clause([name])
            used = [t for t in table_names() if re.search(rf"(from|join)\s+{t}\b", definitions)]
            tables = ", ".join(self._register(t, DEALT.get(name, {}).get(t)) for t in used)
            df = self.spark.sql(f"with {tables}, {definitions} select * from {name}")
            zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
            self._made[name] = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})
        return self._made[name]
