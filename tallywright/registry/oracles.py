"""The same results in SQL for DuckDB, written from the meaning of each report and not from the Spark plan. Rules, categories
and patterns are spelled out here again, so that a wrong one in the library turns its row red.

Laterals are correlated subqueries, fan-outs are really fanned out, and the fee rules are one filtered aggregate each.
"""

from __future__ import annotations

from tallywright.registry import settings as s
from tallywright.registry.views import oracle

TREE = """
tree_any as (
    select m.id as mid, m.name as mname, m.entity_type as kind, b.id as bid, b.name as bname,
           g.id as gid, g.name as gname, d.id as did, d.name as dname
    from entity m join entity b on b.id = m.parent_entity_id
    join entity g on g.id = b.parent_entity_id join entity d on d.id = g.parent_entity_id
),
tree as (select distinct * exclude (kind) from tree_any where kind = 5)
"""


def _month_label(value: str) -> str:
    return f"strftime({value}, '%m') || ' - ' || rpad(monthname({value}), 9, ' ')"


def _us_week(day: str) -> str:
    first = f"date_trunc('year', {day})"
    return f"cast((dayofyear({day}) + dayofweek({first}) - 1) // 7 + 1 as int)"


def _week_label(local: str) -> str:
    week = _us_week(f"(cast({local} as date) - 1)")
    return (
        f"cast(year({local}) as varchar) || ' - Week ' || cast(case when month({local}) = 1 and {week} > 50 "
        f"then 1 else {week} end as varchar)"
    )


def _money(value: str) -> str:
    return f"try_cast(nullif(trim(replace(replace(replace({value}, '$', ''), ',', ''), '..', '.')), '') as decimal(17,2))"


PERIOD_LABELS = {
    1: _week_label("local"),
    2: "cast(year(local) as varchar) || ' - ' || monthname(local)",
    3: "cast(year(local) as varchar) || ' - Q' || cast(quarter(local) as varchar)",
    4: "cast(year(local) as varchar)",
}

ORACLES: dict[str, str] = {}


#: The same without the definitions of the logical tables, for queries that build on others.
ORACLE_BODIES: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    ORACLE_BODIES[name] = sql.strip()
    ORACLES[name] = oracle(sql)


# --- statements ----------------------------------------------------------------------------------------------------

add(
    "stmt_transaction_level",
    f"""
with {TREE}
select x.id, x.merchant_id, x.created_at, x.settled_at, x.currency, x.amount / 100e0 as amount,
    x.merchant_fee / 100e0 as merchant_fee, x.buyer_fee / 100e0 as buyer_fee,
    (x.merchant_fee + x.buyer_fee) / 100e0 as revenue, x.type,
    case i.payment_method_type when 'CREDIT_CARD' then i.card_brand when 'DEBIT_CARD' then i.card_brand
        when 'BANK_ACCOUNT' then 'Electronic Check' end as card_category,
    h.mname as merchant_name, h.dname as division_name, h.did as division_id, i.bank_account_type, i.card_brand,
    i.payment_method_type, c.fee_profile_id, f.id as mfp_id, f.created_at as mfp_created_at,
    q.created_at as mp_created_at, monthname(f.created_at - interval 1 month) as "StatementMonth",
    {_month_label("(f.created_at - interval 1 month)")} as "StatementMonthSort"
from mfp f
join mfpmp l on l.merchant_fee_payout_id = f.id
join merchant_payout q on q.id = l.merchant_payout_id
join mpt k on k.merchant_payout_id = q.id
join txn x on x.id = k.transaction_id
join tree h on h.mid = x.merchant_id
left join payment_intent i on i.id = x.payment_intent_id
left join contract c on c.id = i.contract_id
where f.status <> 'FAILED'
""",
)

FANNED = """
fanned as (
    select f.merchant_id, f.created_at as fee_time, date_trunc('month', f.created_at) as fee_month, q.id as pid,
        q.created_at as paid_at, q.funding_type, q.gross_amount, x.id as xid, x.amount, x.type as xtype,
        x.merchant_fee, x.buyer_fee
    from mfp f
    left join mfpmp l on l.merchant_fee_payout_id = f.id
    left join merchant_payout q on q.id = l.merchant_payout_id
    left join mpt k on k.merchant_payout_id = q.id
    left join txn x on x.id = k.transaction_id
    where f.status <> 'FAILED'
)
"""

add(
    "stmt_payout_level",
    f"""
with {TREE}, {FANNED},
paid as (
    select pid, fee_month, case funding_type when 'GROSS' then sum(gross_amount)
        when 'NET' then sum(gross_amount) - sum(merchant_fee + buyer_fee) else 0 end as cents
    from fanned group by pid, fee_month, funding_type
),
counted as (
    select h.mid, h.mname, h.dname, h.did, n.pid, n.fee_time, n.paid_at, count(distinct xid) as txns,
        sum(amount) as volume, sum(if(xtype = 'REVERSAL', 1, 0)) as reversals,
        sum(if(xtype = 'REVERSAL', amount, 0)) as reversed, sum(merchant_fee) + sum(buyer_fee) as fee_cents
    from fanned n join tree h on h.mid = n.merchant_id
    group by all
)
select c.mid as merchant_id, c.mname as merchant_name, c.dname as division_name, c.did as division_id, c.pid as mp_id,
    date_trunc('month', c.fee_time) as mfp_created_at, c.paid_at as mp_created_at, c.txns as txn_count,
    cast(c.volume as bigint) / 100e0 as txn_volume, cast(c.reversals as bigint) as reversal_count,
    cast(c.reversed as bigint) / 100e0 as reversal_amount, cast(c.fee_cents as bigint) / 100e0 as fees,
    cast(p.cents as bigint) / 100e0 / nullif(c.txns, 0) as adjusted_mp_amount
from counted c left join paid p on p.pid = c.pid and p.fee_month = date_trunc('month', c.fee_time)
""",
)

add(
    "stmt_summary_level",
    f"""
with {TREE}, {FANNED},
per_payout as (
    select merchant_id, pid, fee_month, count(distinct xid) as txns, coalesce(sum(amount), 0) as volume,
        coalesce(sum(if(xtype = 'REVERSAL', 1, 0)), 0) as reversals,
        coalesce(sum(if(xtype = 'REVERSAL', amount, 0)), 0) as reversed,
        coalesce(sum(merchant_fee) + sum(buyer_fee), 0) as fee_cents
    from fanned group by all
),
charged as (
    select f.merchant_id, date_trunc('month', f.created_at) as fee_month, sum(coalesce(g.amount, 0)) as cents
    from mfp f
    left join mfpmp l on l.merchant_fee_payout_id = f.id
    left join merchant_payout q on q.id = l.merchant_payout_id
    left join mpc r on r.merchant_payout_id = q.id
    left join charge g on g.id = r.charge_id
    where f.status <> 'FAILED' group by all
)
select h.mid as merchant_id, h.mname as merchant_name, h.dname as division_name, h.did as division_id, p.pid as mp_id,
    coalesce(p.fee_month, c.fee_month) as mfp_created_at, p.txns as txn_count,
    cast(p.volume as bigint) / 100e0 as gross_volume, cast(p.reversals as bigint) as reversal_count,
    cast(p.reversed as bigint) / 100e0 as reversal_amount, cast(p.fee_cents as bigint) / 100e0 as revenue,
    coalesce(cast(c.cents as bigint) / 100e0, 0) as total_charges
from tree h left join per_payout p on p.merchant_id = h.mid
left join charged c on c.merchant_id = h.mid and coalesce(p.fee_month, c.fee_month) = c.fee_month
""",
)

# --- fee profiles --------------------------------------------------------------------------------------------------


def _json_text(path: str) -> str:
    return f"json_extract_string(f.configuration, '$.{path}')"


def _json_fee(path: str, field: str) -> str:
    text = _json_text(f"{path}.{field}" if path else field)
    if field.lower().endswith("interchangeplus"):
        return text
    amount = f"try_cast({text} as decimal(10,2))"
    return f"cast({amount} / 100 as decimal(14,6))" if field.endswith("Pct") else amount


_fee_columns = [
    *[
        f"{_json_fee('defaultAchFees', c)} as \"{'buyerPCT' if c == 'buyerPct' else c}\""
        for c in ("buyerPct", "merchantPct", "buyerFixedFee", "debitReturnFee", "creditReturnFee", "merchantFixedFee")
    ],
    *[
        f'{_json_fee("defaultCardFees", c)} as "{c}_card"'
        for c in ("buyerPct", "merchantPct", "buyerFixedFee", "merchantFixedFee")
    ],
    *[
        f"""{_json_fee(f'networkSpecificFees."{network}"', c)} as "{short}_{c}\""""
        for short, network in (
            ("AMEX", "American Express"), ("Visa", "Visa"), ("MasterCard", "MasterCard"), ("Discover", "Discover")
        )
        for c in ("buyerPct", "merchantPct", "buyerFixedFee", "merchantFixedFee", "interChangePlus")
    ],
    f'{_json_fee("", "disputeFixedFee")} as "disputeFixedFee"',
    f'{_json_fee("", "disputeInquiryFixedFee")} as "disputeInquiryFixedFee"',
    f'{_json_text("defaultInterChangePlus")} as "defaultInterChangePlus"',
]
_names = ", ".join(
    f"""case when {_json_text(f'networkSpecificFees."{n}".buyerPct')} is not null then '{n}' end"""
    for n in ("American Express", "Visa", "MasterCard", "Discover")
)

add(
    "fee_profiles",
    f"""
with {TREE}
select f.id as fee_profile_id, h.mid as merchant_entity_id, h.mname as merchant_name, h.bid as business_id,
    h.bname as business_name, h.gid as business_group_id, h.gname as business_group_name, h.did as division_id,
    h.dname as division_name, n.mid, o.is_active, f.start_date as "FROM", f.end_date as "TO",
    {", ".join(_fee_columns)},
    case when {_json_text("networkSpecificFees")} = '{{}}' then null else concat_ws(', ', {_names}) end
        as "networkSpecificFeesName"
from tree h
left join merchant_fee_profile o on o.merchant_id = h.mid
left join merchant n on n.id = h.mid
left join fee_profile f on f.id = o.fee_profile_id
""",
)

# --- ledgers -------------------------------------------------------------------------------------------------------

_counted = "(v.fee_category <> 5 or v.source not like 'PayFac%')"

add(
    "profitability_daily",
    f"""
with {TREE},
days as (select cast(unnest(generate_series(date '{s.START}', date '{s.END}', interval 1 day)) as date) as day),
activity as (
    select h.did, h.dname, x.activity_date as day, count(*) as n,
        sum(if(card_present = 'true', settlement_amount, 0)) as s_core,
        sum(if(card_present = 'false', settlement_amount, 0)) as s_vap, sum(settlement_amount) as s_all,
        sum(merchant_fee + buyer_fee) as rev,
        sum(if(card_present = 'true', interchange_amount, 0)) as i_core,
        sum(if(card_present = 'false', interchange_amount, 0)) as i_vap, sum(interchange_amount) as i_all,
        sum(if(card_present = 'true' and transaction_type = 'CREDIT', interchange_amount, 0)) as i_credit,
        sum(if(card_present = 'true' and transaction_type = 'DEBIT', interchange_amount, 0)) as i_debit,
        sum(if(card_present = 'true' and transaction_type = 'REVERS', interchange_amount, 0)) as i_reversed
    from ledger_transaction x join tree_any h on h.mid = x.merchant_entity_id group by all
),
other as (
    select h.did, h.dname, v.statement_date as day, sum(if(v.source like 'PayFac%', 0, v.amount)) as o_core,
        sum(case when v.source like 'PayFac%' then v.amount end) as o_vap, sum(v.amount) as o_all
    from merchant_fee v join tree_any h on h.mid = v.merchant_entity_id where {_counted} group by all
)
select coalesce(a.did, o.did) as division_id, coalesce(a.dname, o.dname) as division_name,
    cast(coalesce(sum(a.n), 0) as bigint) as transaction_count, c.day as activity_date,
    cast(coalesce(sum(s_core), 0) as decimal(38,2)) as settlement_amount_core,
    cast(coalesce(sum(s_vap), 0) as decimal(38,2)) as settlement_amount_vap,
    cast(coalesce(sum(s_all), 0) as decimal(38,2)) as settlement_amount,
    cast(coalesce(sum(rev), 0) as decimal(38,3)) as revenue,
    cast(coalesce(sum(o_core), 0) as decimal(38,2)) as otherfees_core,
    cast(coalesce(sum(o_vap), 0) as decimal(38,2)) as otherfees_vap,
    cast(coalesce(sum(o_all), 0) as decimal(38,2)) as otherfeesamount,
    cast(coalesce(sum(i_core), 0) as decimal(38,2)) as interchange_core,
    cast(coalesce(sum(i_vap), 0) as decimal(38,2)) as interchange_vap,
    cast(coalesce(sum(i_all), 0) as decimal(38,2)) as interchange_amount,
    cast(coalesce(sum(i_credit), 0) as decimal(38,2)) as interchange_credit_card,
    cast(coalesce(sum(i_debit), 0) as decimal(38,2)) as interchange_debit_card,
    cast(coalesce(sum(i_reversed), 0) as decimal(38,2)) as reversals_core
from days c left join activity a on a.day = c.day
left join other o on o.day = c.day and coalesce(a.did, o.did) = o.did and coalesce(a.dname, o.dname) = o.dname
group by 1, 2, 4
""",
)


def _calendar(value: str) -> str:
    return f"""cast(year({value}) as int) as year, {_month_label(value)} as month_name,
    cast(month({value}) as int) as month, cast(day({value}) as int) as day, cast(quarter({value}) as int) as quarter,
    cast(weekofyear({value}) as int) as week,
    strftime({value}, '%m-%d-%Y') || ' - ' || rpad(dayname({value}), 9, ' ') as day_of_week_date,
    date_trunc('month', {value}) as first_day_of_month, date_trunc('quarter', {value}) as first_day_of_quarter,
    date_trunc('year', {value}) as first_day_of_year"""


_merchant = """h.mname as merchant_name, h.mid as merchant_entity_id, h.bname as business_name, h.bid as business_id,
    h.gname as business_group_name, h.gid as business_group_id, h.dname as division_name, h.did as division_id"""

add(
    "transaction_ledger",
    f"""
with {TREE}
select x.id, x.payment_intent_id, x.payment_method_id, x.merchant_id, x.mid, x.currency,
    cast(null as varchar) as "Description", x.amount / 100e0 as "Amount", x.buyer_fee / 100e0 as buyer_fee,
    x.merchant_fee / 100e0 as merchant_fee, (x.buyer_fee + x.merchant_fee) / 100e0 as "Revenue", x.type, x.status,
    x.payment_method_type, x.funding_status, x.created_at, {_calendar("x.created_at")}, x.settled_at, x.can_be_paid,
    x.funded_at, x.network_transaction_id, x.original_transaction_id, q.gross_amount / 100e0 as mp_amount,
    q.created_at as mp_created_at, f.amount / 100e0 as mfp_amount,
    {_month_label("(f.created_at - interval 1 month)")} as "StatementMonth", {_merchant}
from txn x join tree h on h.mid = x.merchant_id
left join mpt k on k.transaction_id = x.id
left join merchant_payout q on q.id = k.merchant_payout_id
left join mfpmp l on l.merchant_payout_id = q.id
left join mfp f on f.id = l.merchant_fee_payout_id
where h.mid not in {s.EXCLUDED_MERCHANTS}
union all by name
select g.id, g.entity_id as merchant_id, g.description as "Description", g.amount / 100e0 as "Revenue", g.type,
    g.funding_status, g.created_at, {_calendar("g.created_at")}, g.funded_at, {_merchant}
from charge g left join tree h on h.mid = g.entity_id
left join mpc r on r.charge_id = g.id
left join merchant_payout q on q.id = r.merchant_payout_id
left join mfpmp l on l.merchant_payout_id = q.id
left join mfp f on f.id = l.merchant_fee_payout_id
where g.created_at > timestamp '{s.CHARGES_AFTER}'
""",
)

_accounts = " ".join(f"when '{k}' then '{v}'" for k, v in s.ACCOUNTS.items())

add(
    "operating_account",
    f"""
with {TREE},
chosen as (select mid, did, dname from tree_any where did in {s.DIVISIONS}),
costs as (
    select did, dname,
        activity_date + case when card_present = 'true' and transaction_type in ('CREDIT', 'DEBIT') then 1
            when card_present = 'false' then 2 else 0 end as day,
        case when card_present = 'true' and transaction_type = 'CREDIT' then 'interchange_credit_card'
            when card_present = 'true' and transaction_type = 'DEBIT' then 'interchange_debit_card'
            when card_present = 'false' then 'ac_vantiv_ecomm'
            when transaction_type = 'REVERS' then 'reversals_core' end as ref,
        if(transaction_type = 'REVERS', settlement_amount, interchange_amount) as cost
    from ledger_transaction x join chosen on mid = x.merchant_entity_id
    union all
    select did, dname, statement_date + if(v.source like 'PayFac%', 2, 10),
        if(v.source like 'PayFac%', 'ac_vantiv_ecomm', 'otherfees_core'), -v.amount
    from merchant_fee v join chosen on mid = v.merchant_entity_id where {_counted}
),
booked as (
    select did, dname, day, ref, sum(cost) as costs, 0 as revenue from costs where ref is not null group by all
    union all
    select did, dname, activity_date, 'revenue', 0, sum(merchant_fee + buyer_fee)
    from ledger_transaction x join chosen on mid = x.merchant_entity_id group by all
)
select did as division_id, dname as division_name, cast(day as date) as ledger_date, ref as "Reference_Text",
    cast(costs as decimal(38,2)) as costs, cast(revenue as decimal(38,3)) as revenue,
    case did {_accounts} else 'Other' end as operating_acct
from booked
""",
)

# --- fee categories ------------------------------------------------------------------------------------------------


# What the rules of the categories ask for, in short names.
_TESTS = {
    "known": "Payment_Type not ilike 'Not Applicable'",
    "gateway": "Fee_Category_Type ilike 'Vantiv Fees'",
    "network": "Fee_Category_Type not ilike 'Vantiv Fees'",
    "amex": "Payment_Type ilike 'American Express'",
    "echeck": "Payment_Type ilike 'Electronic Check'",
    "card": "Payment_Type not ilike 'American Express' and Payment_Type not ilike 'Electronic Check'",
    "debit": "Description ilike '%DEBIT%'",
    "no debit": "Description not ilike '%DEBIT%'",
    "regulated": "Description ilike '%Regulated%'",
    "unregulated": "Description not ilike '%Regulated%'",
    "optblue": "Description ilike '%INT AMEX OptBlue%'",
    "no avs": "Description not ilike '%AVS%'",
    "no debit fee": "Fee_Category not ilike '%DEBIT%'",
    "assessments": "Fee_Category ilike 'Assessments'",
    "no assessments": "Fee_Category not ilike 'Assessments'",
    "authorizations": "Fee_Category ilike 'Authorizations'",
    "no authorizations": "Fee_Category not ilike 'Authorizations'",
    "interchange": "Fee_Category ilike 'Credit Interchange'",
    "no interchange": "Fee_Category not ilike 'Credit Interchange'",
    "acceptance": "Fee_Category ilike 'Payments Acceptance'",
    "revenue": "Fee_Category ilike 'Revenue Solutions'",
    "no revenue": "Fee_Category not ilike 'Revenue Solutions'",
    "chargebacks": "Fee_Sub_Category ilike 'Chargebacks/Returns'",
    "no chargebacks": "Fee_Sub_Category not ilike 'Chargebacks/Returns'",
    "group x": "reporting_group ilike 'REPORTING_GROUP_X'",
}
# The categories with what is added up and what is asked for.
_FEES, _COUNT, _AMOUNT = ("Total_Fees", "decimal(18,2)"), ("Txn_Count", "int"), ("Txn_Amount", "decimal(18,2)")
_FEE_CATEGORIES = (
    ("03_WP - Credit Card (Visa,MC,Dis)-Total Network Costs", _FEES, "known, network, no revenue, card, no debit, no assessments"),
    ("04_Intermediate - CC and Debit Gateway Fees", _FEES, "known, gateway, no chargebacks, no revenue, card"),
    ("06_WP - Credit Card (Visa,MC,Dis)-Assesments", _FEES, "known, network, card, no debit, assessments"),
    ("08_WP - Credit Cards (AMEX) - Total Network Costs", _FEES, "amex, network, no assessments, no authorizations"),
    ("American Express OptBlue Assesment", _FEES, "optblue"),
    ("09_WP - Credit Cards (AMEX) - Total Gateway Costs", _FEES, "gateway, no revenue, amex, no chargebacks"),
    ("10_WP - Credit Cards (AMEX) - Brand Assesments", _FEES, "amex, network, assessments"),
    ("16_WP - Regulated DEBIT Cards - Total Interchange Costs", _FEES, "group x, known, network, debit, regulated, no assessments, no authorizations"),
    ("20_WP - UnRegulated DEBIT Cards - Total Interchange Costs", _FEES, "group x, known, network, debit, unregulated, no assessments, no authorizations"),
    ("13_WP - Combined DEBIT Cards Assesments", _FEES, "known, network, debit, unregulated, assessments"),
    ("14_WP - Combined DEBIT Cards Authorizations", _FEES, "known, network, debit, unregulated, authorizations"),
    ("24_WP - eCheck - Total Gateway Costs", _FEES, "gateway, echeck, acceptance"),
    ("26_WP - Account Updater Costs", _FEES, "known, no debit fee, gateway, revenue"),
    ("27_WP - Chargeback Costs", _FEES, "known, no debit fee, gateway, chargebacks"),
    ("30_WP - Credit Card Counts (Visa,MC,Dis)", _COUNT, "known, network, no revenue, card, no debit, no assessments, no interchange, no avs"),
    ("31_WP - Credit Card Counts (AMEX)", _COUNT, "gateway, no revenue, amex"),
    ("32_WP - UnRegulated Debit Card Counts", _COUNT, "group x, known, network, debit, unregulated, no assessments, no authorizations"),
    ("33_WP - Regulated Debit Card Counts", _COUNT, "known, network, debit, regulated, no assessments, no authorizations"),
    ("37_WP - Credit Card $$$ (AMEX)", _AMOUNT, "gateway, no revenue, amex"),
    ("39_WP - Regulated Debit Card", _AMOUNT, "known, network, debit, regulated, no assessments, no authorizations"),
    ("40_WP - eCheck", _AMOUNT, "gateway, echeck, acceptance"),
    ("34_WP - eCheck Counts", _COUNT, "gateway, echeck, acceptance"),
    ("36_WP - Credit Card (Visa,MC,Dis)", _AMOUNT, "known, network, card, no debit, interchange"),
    ("38_WP - UnRegulated Debit Card", _AMOUNT, "known, network, debit, unregulated, no assessments, no authorizations"),
)

add(
    "merchant_processing_view",
    "\nunion all\n".join(
        f"""select "Month", "CLUB", "isXPO", '{label}' as "Value", cast(sum(cast({column} as {kind})) as decimal(28,2)) as "Amount"
        from fee_lines where {" and ".join(_TESTS[t] for t in tests.split(", "))} group by all"""
        for label, (column, kind), tests in _FEE_CATEGORIES
    ),
)

# --- stores --------------------------------------------------------------------------------------------------------


# Brands with their place, name and patterns (of the store's name, then of the chain's), and rebate chains.
_BRANDS = (
    (1, "BRAND_D", "BRAND_D%", None), (2, "BRAND_S", "BRAND_R%", "BRAND_S%"), (3, "BRAND_F", "BRAND_F%", None),
    (4, "BRAND_G", "BRAND_G%", None), (5, "BRAND_T", "BRAND_T%", None), (6, "BRAND_U", "BRAND_U%", None),
    (7, "BRAND_V", "BRAND_V%", None), (8, "BRAND_W", "BRAND_W%", None), (9, "BRAND_Q", "BRAND_Q%", None),
    (10, "BRAND_A", "BRAND_A%", None), (11, "BRAND_B", "BRAND_B%", None), (12, "BRAND_Y", "BRAND_Y%", None),
    (13, "BRAND_H", "BRAND_H%", None), (14, "BRAND_J", "BRAND_J%", None), (15, "BRAND_P", "BRAND_P%", None),
)
_REBATES = (("BRAND_A%", "US", 1), ("BRAND_B%", "US", 2), ("BRAND_C%", "US", 3), ("BRAND_P%", "US", 21), ("BRAND_P%", "CA", 22), ("BRAND_Q%", "CA", 23))


def _brand_sql(brands, place: int, otherwise: str) -> str:
    whens = []
    for brand in brands:
        test = f"p.LocationName ilike '{brand[2]}'" + (f" or h.ChainName ilike '{brand[3]}'" if brand[3] else "")
        whens.append(f"when {test} then {brand[place]!r}")
    return f"case {' '.join(whens)} else {otherwise} end"


def _rebate_sql(params) -> str:
    whens = " ".join(f"when p.LocationName ilike '{like}' and p.clubcountry = '{country}' then {chain}" for like, country, chain in _REBATES)
    return (
        f"case when o.ChainID is null or o.ChainID = {params.mixed_chain_id or -999} then case {whens} end "
        "else o.ChainID end"
    )


_STORE_FROM = """
from stores o
left join general_prefs p on p.StoreID = o.StoreID
left join store_status st on st.StoreStatusId = o.Status
left join chains h on h.ChainID = o.ChainID
left join cas_clubs u on u.StoreID = o.StoreID
left join cas_companies y on y.CASCompanyID = u.CasCompanyID
left join store_info i on i.StoreId = o.StoreID
left join site_type z on z.SiteTypeId = i.SiteTypeId
"""


def _store_sql(params, chain: str, chain_name: str, brand: str, no_site: str) -> str:
    return f"""
select cast({chain} as int) as "ChainId", cast({_rebate_sql(params)} as int) as "ChainIdRebates",
    {chain_name} as "ChainName", {brand} as "BrandName", o.StoreID as "StoreId",
    p.LocationName || case when o.Deleted = 1 then ' (Deleted)' else '' end as "LocationName",
    p.clubcountry as "ClubCountry", p.ClubState as "ClubState", o.Status as "Status", st.Name as "StoreStatus",
    coalesce(z.Name, '{no_site}') as "SiteType", p.TimeOffset as "TimeOffset",
    coalesce(y.CompanyName, 'DIY') as "RemitGroup", y.CASCompanyID as "CasCompanyId",
    y.IsRemitGroupEnabled as "IsRemitGroupEnabled", u.IsRemitClubEnabled as "IsRemitClubEnabled",
    o.CollectionsBy as "CollectionsBy", o.Deleted as "Deleted", i.SiteTypeId as "SiteTypeId",
    case when u.CasClubId is null then 'DIY' else 'FS' end as "BillingType",
    trim(coalesce(p.ClubAddress, '')) || ' ' || trim(coalesce(p.ClubCity, ''))
        || case when coalesce(trim(p.ClubState), '') = '' then ' ' else ', ' end || trim(coalesce(p.ClubState, ''))
        || ' ' || trim(coalesce(p.ClubZip, '')) as "Address",
    trim(coalesce(case lower(p.ClubState) when 'kentucky' then 'KY' when 'massachusetts' then 'MA'
        when 'texas' then 'TX' when 'fl' then 'FL' else p.ClubState end, '')) as "State"
{_STORE_FROM}"""


_statuses = "o.Status in (1, 2, 3, 7, 13, 14, 15)"
_remit_brand = _brand_sql([b for b in _BRANDS if b[0] in (1, 2, 15)], 1, "coalesce(h.ChainName, 'No Brand Assigned')")
_remit_all = _store_sql(s.REMIT, "o.ChainID", "h.ChainName", _remit_brand, "-")

add("store_dimension_remit", f"{_remit_all} where {_statuses} and (p.clubcountry <> 'CA' or p.clubcountry is null)")

_brand_id = _brand_sql(_BRANDS, 0, "o.ChainID")
_brand_name = _brand_sql(_BRANDS, 1, "coalesce(h.ChainName, 'No Brand Assigned')")
_chain_brand = " ".join(
    "when " + " or ".join(f"h.ChainName ilike '{p}'" for p in (like, chain_like) if p) + f" then {place}"
    for place, _, like, chain_like in _BRANDS
)

add(
    "store_dimension_brand",
    f"""{_store_sql(s.BRAND, _brand_id, _brand_name, _brand_name, "No Site Type")}
where {_statuses} and coalesce({_brand_id}, -1) in (
    select case {_chain_brand} else h.ChainID end from chains h
    where h.Deleted is null and h.ChainName <> '' and h.ChainName not ilike '%test%'
        and h.ChainName not ilike '%demo%' and h.ChainName not ilike '%delete%' and h.ChainID <> 2
    union all select unnest([-1, -2, -3, -4]))
""",
)


def _accrual(cutoff: str) -> str:
    return f"""(select sum(a.Amount) from remit_adjustments a left join cas_reconcile r on r.CasReconcileId = a.ReconcileId
        where a.StoreId = o.StoreID and (a.Accrual = 1 or a.RemitAdjustmentTypeId = 4) and r.Cutoff < {cutoff})"""


_accrual_rows = f"""
select o.StoreID as "StoreId", i.SiteTypeId as "SiteTypeId",
    cast(coalesce({{0}}, 0) as decimal(17,2)) as "AccrualBalance"
from stores o left join store_info i on i.StoreId = o.StoreID
where {_statuses} and (i.SiteTypeId <> 4 or i.SiteTypeId is null)
"""

add("store_accrual_balance", _accrual_rows.format(_accrual(f"date '{s.CUTOFF}'")))
add(
    "store_accrual_positive",
    f"""select * from ({_accrual_rows.format(_accrual(f"date '{s.CUTOFF}' + 1"))}) where "AccrualBalance" > 0""",
)


def _period_sql(period: int, tenders: str, cutoff: str = "") -> str:
    balance = f"and coalesce({_accrual(cutoff)}, 0) > 0" if cutoff else ""
    return f"""
with local_payments as (
    select m.*, m.PaymentDate + to_hours(p.TimeOffset) as local
    from payments m join stores o on o.StoreID = m.StoreID left join general_prefs p on p.StoreID = o.StoreID
        left join store_info i on i.StoreId = o.StoreID
    where {_statuses} and {tenders} and (i.SiteTypeId <> 4 or i.SiteTypeId is null) {balance}
)
select StoreID as "StoreID", {PERIOD_LABELS[period]} as "PeriodDisplay",
    case PurchaseWith when 1 then 'CC Txn' when 6 then 'eCheck Txn' else 'Other Txn' end as "TransactionCategory",
    'Transactions' as "TransactionType",
    cast(sum({_money("coalesce(TotalAmount, Amount)")}) as decimal(37,2)) as "Amount",
    count(PaymentID) as "TransactionCount"
from local_payments
where local >= timestamp '{s.START}' and local < timestamp '{s.END}' + interval 1 day
group by all
"""


add("store_period_transactions", _period_sql(1, "true"))
add("management_financials_today", _period_sql(2, "true", f"date '{s.TODAY}'"))
add("management_financials_end", _period_sql(2, "true", f"date '{s.END}' + 1"))
add("store_month_transactions", _period_sql(2, "m.PurchaseWith in (1, 6)"))
add("store_quarter_transactions", _period_sql(3, "m.PurchaseWith = 1"))
add("store_year_transactions", _period_sql(4, "m.PurchaseWith = 6"))

# --- franchise fees ------------------------------------------------------------------------------------------------

_place = "p.LocationName || ' [' || cast({0} as varchar) || ']' as \"Location\", trim(coalesce(p.ClubState, '')) as \"ClubState\""
_in_period = f"l.ToDate >= date '{s.START}' and l.ToDate < date '{s.END}' + 1"
_tail = 'o.ExternalStoreID as "ExternalStoreId", o.CollectionsBy as "CollectionsBy"'
_named = """join stores o on o.StoreID = l.CoreId and l.CoreTypeId = 3 and o.ChainID is not null
    left join general_prefs p on p.StoreID = o.StoreID"""
# The report's categories, the settlement columns behind them, and the fees told by category and name.
_CATEGORIES = (
    "franchisefee1", "franchisefee1Adj", "franchisefee2", "franchisefee2Adj", "CardPresent", "Down", "Products", "Draft",
    "Collections", "Refunds", "Returns", "NetTotal", "Tax", "TotalAfterTax", "CrCardDraft", "ECheckDraft", "CashDraft",
    "WrittenCheckDraft", "ExtTerminalDraft", "ACHAdjustments", "AmexAdjustments", "HeartMonitorFee", "CorporateEmailFee",
    "InsuranceFee", "CorporateFee", "CorpAdj", "DigitalMarketingService", "SoftwareFee", "directcoll", "RemitStatementFee",
    "LeadSpeakFee", "NowFee", "EmmaFee", "WorkoutScreens", "PCICompliance", "CRConnect", "VTS",
)
_SETTLED = (
    ("UpFront_PilTotal_Total", "Down"), ("Draft_PilTotal_Total", "Draft"), ("Product_PilTotal_Total", "Products"),
    ("Pdc_PilTotal_Total", "Collections"), ("PdcDirect_PilTotal_Total", "DirectColl"), ("Refund_RefundTotal_Total", "Refunds"),
    ("Return_PaymentTotal_Total", "Returns"), ("Net_Total", "NetTotal"), ("SalesTax_Total", "Tax"),
    ("Total_AfterTax", "TotalAfterTax"), ("Draft_PilTotal_Ach", "ECheckDraft"), ("Draft_PilTotal_Cash", "CashDraft"),
    ("Draft_PilTotal_WrittenCheck", "WrittenCheckDraft"), ("Draft_PilTotal_External", "ExtTerminalDraft"),
)
_NAMED = (
    ("HeartMonitorFee", 3, "Heart%"), ("CorporateEmailFee", 3, "%Corp%Email%"),
    ("DigitalMarketingService", 3, "%Digital Marketing Service%"), ("NowFee", 3, "%9r%now%"), ("EmmaFee", 3, "emma%"),
    ("WorkoutScreens", 3, "Workout Screens%"), ("PCICompliance", 17, "%PCI Compliance%"), ("CRConnect", 35, "%CR%Connect%"),
    ("VTS", 3, "%VTS%"),
)
_categories = ", ".join(repr(c) for c in _CATEGORIES)

SKELETON = f"""
select o.StoreID as "CoreId", 3 as "CoreTypeId", {_place.format("o.StoreID")}, unnest([{_categories}]) as "Category",
    cast(0 as decimal(17,2)) as "Amount", {_tail}
from stores o join general_prefs p on p.StoreID = o.StoreID
where o.ChainID is not null
qualify row_number() over (partition by o.ChainID order by o.StoreID) = 1
"""


def _named_fee(column: str, category: int, pattern: str) -> str:
    return f"""cast((select sum(v.Amount) from settlement_log_fee v
        join settlement_log a on a.SettlementLogId = v.SettlementLogId
        join settlement_log b on b.ReconcileId = a.ReconcileId and b.CoreId = a.CoreId and b.CoreTypeId = a.CoreTypeId
        where v.FeeCategoryId = {category} and v.FeeName ilike '{pattern}' and b.CoreId = o.StoreID
            and a.FromDate between l.FromDate and l.ToDate) as decimal(17,2)) as "{column}\""""


_own = ", ".join(f'cast(l.{column} as decimal(17,2)) as "{category}"' for column, category in _SETTLED)
_fee_sums = ", ".join(_named_fee(*fee) for fee in _NAMED)

WIDE = f"""
select distinct l.CoreId as "CoreId", l.CoreTypeId as "CoreTypeId", {_place.format("l.CoreId")},
    l.ReconcileId as "ReconcileId", l.ToDate as "ToDate", l.FromDate as "FromDate", {_own},
    cast(l.Draft_PilTotal_Vmd + l.Draft_PilTotal_Amex as decimal(17,2)) as "CrCardDraft",
    o.CollectionsBy as "CollectionsBy", o.ExternalStoreID as "ExternalStoreId",
    cast(coalesce((select sum(a.Amount) from remit_adjustments a where a.CreatedByReconcileId = l.ReconcileId
        and a.QuickbookSubcategoryId in (85, 86) and a.StoreId = l.CoreId), 0) as decimal(17,2)) as "ACHAdjustments",
    cast(coalesce((select sum(-a.Amount) from remit_adjustments a where a.CreatedByReconcileId = l.ReconcileId
        and a.QuickbookSubcategoryId in (80, 81) and a.StoreId = l.CoreId), 0) as decimal(17,2)) as "AmexAdjustments",
    cast((select sum(a.Amount) from remit_adjustments a left join cas_clubs u on u.StoreID = a.StoreId
        where a.ReconcileId = l.ReconcileId and a.CoreTypeId = l.CoreTypeId and a.CoreId = l.CoreId and a.Chain = 1
        and a.AdjustmentForFeeId is null) as decimal(17,2)) as "CorpAdj",
    cast((select sum({_money("m.TotalAmount")}) from payments m where m.StoreID = o.StoreID and m.PurchaseWith = 1
        and m.GatewayType = 'CP' and cast(m.PaymentDate as date) between l.FromDate and l.ToDate) as decimal(17,2))
        as "CardPresent",
    {_fee_sums}
from settlement_log l {_named} where {_in_period}
"""

_measures = [category for _, category in _SETTLED]
_measures += ["CrCardDraft", "ACHAdjustments", "AmexAdjustments", "CorpAdj", "CardPresent", *(fee[0] for fee in _NAMED)]
LONG = f"""
select "CoreId", "CoreTypeId", "Location", "ClubState", "Category", "Amount", "ExternalStoreId", "CollectionsBy"
from (unpivot wide on {", ".join(f'"{m}"' for m in _measures)} into name "Category" value "Amount")
"""

LINES = f"""
select l.CoreId as "CoreId", l.CoreTypeId as "CoreTypeId", {_place.format("l.CoreId")}, n.Name as "Category",
    cast(v.Amount as decimal(17,2)) as "Amount", {_tail}
from settlement_log l {_named}
join settlement_log_fee v on v.SettlementLogId = l.SettlementLogId
join reconcile_fee k on k.ReconcileFeeId = v.ReconcileFeeId
left join fee_category n on n.FeeCategoryId = v.FeeCategoryId
where {_in_period} and v.FeeCategoryId <> 3
"""

ADJUSTMENTS = f"""
select distinct l.CoreId as "CoreId", l.CoreTypeId as "CoreTypeId", {_place.format("l.CoreId")},
    trim(n.Name) || 'adj' as "Category",
    cast(sum(coalesce(a.Amount, 0)) over (partition by n.Name, l.CoreId, l.CoreTypeId, p.LocationName) as decimal(17,2))
        as "Amount", {_tail}
from settlement_log l {_named}
join remit_adjustments a on a.ReconcileId = l.ReconcileId and a.CoreId = l.CoreId and a.CoreTypeId = l.CoreTypeId
join reconcile_fee k on k.ReconcileFeeId = a.AdjustmentForFeeId
left join fee_category n on n.FeeCategoryId = k.FeeCategoryId
where {_in_period}
"""

STAGING = f"""
wide as materialized ({WIDE}),
staged as ({SKELETON} union all by name {LONG} union all by name {LINES} union all by name {ADJUSTMENTS})
"""

add("ff_category_skeleton", SKELETON)
add("ff_settlement_wide", WIDE)
add("ff_fee_lines", LINES)
add("ff_fee_adjustments", ADJUSTMENTS)
add("franchise_fee_staging", f"with {STAGING} select * from staged")

_columns = sorted(
    {*_CATEGORIES, *s.FEE_CATEGORY_NAMES, *[n + "adj" for n in s.FEE_CATEGORY_NAMES]},
)
_pivoted = ", ".join(
    (
        f"""cast(coalesce(sum(amt) filter (cat = '{c.lower()}'), 0) as decimal(38,2)) as "{c}\""""
        if c in ("SoftwareFee", "RemitStatementFee", "NowFee", "EmmaFee")
        else f"""cast(sum(amt) filter (cat = '{c.lower()}') as decimal(38,2)) as "{c}\""""
    )
    for c in _columns
)


def _report_accrual(cutoff: str) -> str:
    return f"""cast(coalesce((select -sum(a.Amount) from remit_adjustments a
        left join cas_reconcile r on r.CasReconcileId = a.ReconcileId
        where a.StoreId = w."CoreId" and (a.Accrual = 1 or a.RemitAdjustmentTypeId = 4) and r.Cutoff < {cutoff}), 0)
        as decimal(17,2))"""


add(
    "franchise_fee_report",
    f"""
with {STAGING},
spread as (
    select g."CoreId", g."CoreTypeId", g."Location", g."ExternalStoreId", g."CollectionsBy", g."ClubState",
        e.ChainName, e.ChainId, lower(rtrim(g."Category")) as cat, coalesce(g."Amount", 0) as amt
    from staged g join store_detail e on e.StoreId = g."CoreId" left join cas_clubs u on u.StoreID = g."CoreId"
),
pivoted as (
    select "CoreId", "CoreTypeId", "Location", "ExternalStoreId", "CollectionsBy", "ClubState", ChainName, ChainId,
        {_pivoted}
    from spread group by 1, 2, 3, 4, 5, 6, 7, 8
)
select w.* exclude ("CoreId", "CoreTypeId", ChainName, ChainId), w."CoreId" as "StoreId", w.ChainName as "ChainName",
    w.ChainId as "ChainId", {_report_accrual(f"date '{s.REPORT_DATE}'")} as "PastAccrualBalance",
    {_report_accrual("date '2001-02-28'")} as "CurrentAccrualBalance",
    cast(coalesce((select sum(k.FeeMin) from reconcile_fee k where k.FeeName ilike '%Workout%System%'
        and k.StartUtc <= timestamp '{s.AS_OF}' and k.CoreId = w."CoreId" and k.CoreTypeId = 3), 0) as bigint) as "WorkoutSystemFee"
from pivoted w
""",
)

add(
    "reconcile_fee_minimums",
    f"""
select o.StoreID as "StoreId", {", ".join(
        f'''cast(coalesce((select sum(k.FeeMin) from reconcile_fee k where k.FeeName ilike '{pattern}'
            and k.StartUtc <= timestamp '{s.AS_OF}' and k.CoreId = o.StoreID and k.CoreTypeId = 3), 0) as bigint) as "{name}"'''
        for name, pattern in (("WorkoutSystemFee", "%Workout%System%"), ("OtherFee", "Fee%"))
    )}
from stores o
""",
)

# --- documents -----------------------------------------------------------------------------------------------------

add(
    "workbook_split",
    """
select coalesce(nullif(group_name, ''), 'n/a') as group_name, coalesce(nullif(merchant_id, ''), 'n/a') as merchant_id,
    coalesce(nullif(contact_phone, ''), 'n/a') as contact_phone, annual_sales_volume
from workbook_rows
""",
)

add(
    "workbook_sheets",
    """
select coalesce(nullif(group_name, ''), 'n/a') as workbook, coalesce(nullif(merchant_id, ''), 'n/a') as merchant_id,
    coalesce(nullif(contact_phone, ''), 'n/a') as contact_phone, annual_sales_volume,
    1 + row_number() over (partition by coalesce(nullif(group_name, ''), 'n/a') order by merchant_id) as row_no
from workbook_rows
""",
)

_head = [
    (1, "Company Name Here"), (2, "Company Address Here"), (3, "City, State, ZIP Code"), (4, "+1 XXX-XXX-XXXX"),
    (5, "Statement Period: MM-DD-YYYY to MM-DD-YYYY"),
]
_sheets = [
    ("Account Info", "merchant_id, merchant_name", "select merchant_id as m, merchant_id || chr(9) || merchant_name as cells, merchant_name as ord from account_info"),
    ("Summary", "fee_payouts, fee_cents", "select merchant_id as m, cast(count(*) as varchar) || chr(9) || cast(sum(amount) as varchar) as cells, '' as ord from mfp group by merchant_id"),
    ("Deposit Detail", "merchant_payout_id, funding_type, gross_amount", "select f.merchant_id as m, q.id || chr(9) || q.funding_type || chr(9) || cast(q.gross_amount as varchar) as cells, q.id as ord from mfp f join mfpmp l on l.merchant_fee_payout_id = f.id join merchant_payout q on q.id = l.merchant_payout_id where f.status <> 'FAILED'"),
    ("Platform Fees", "fee_payout, status, amount", "select merchant_id as m, id || chr(9) || status || chr(9) || cast(amount as varchar) as cells, id as ord from mfp"),
    ("Charges", "charge, type, amount", "select entity_id as m, id || chr(9) || type || chr(9) || cast(amount as varchar) as cells, id as ord from charge"),
]
_parts = []
for _no, (_title, _names_, _rows) in enumerate(_sheets, start=1):
    for _row, _text in [*_head, (7, _title), (9, _names_)]:
        _line = f"replace('{_text}', ', ', chr(9))" if _row == 9 else f"'{_text}'"
        _parts.append(f"select m, {_no} as section_no, '{_title}' as section, {_row} as row_no, {_line} as line from wanted")
    _parts.append(
        f"select r.m, {_no}, '{_title}', 9 + row_number() over (partition by r.m order by r.ord), r.cells "
        f"from ({_rows}) r where r.m in (select m from wanted)"
    )

add(
    "statement_pack",
    f"""
with wanted as (select distinct merchant_id as m from account_info)
select m as merchant_id, cast(section_no as int) as section_no, section, cast(row_no as bigint) as row_no, line
from ({" union all ".join(_parts)})
""",
)



def _cells(columns: str) -> str:
    """Values of a line parted by tabs; those marked $ are money with two decimals."""
    one = lambda c: f"cast(cast({c[1:]} as varchar) as decimal(38,2))" if c[0] == "$" else c
    return " || chr(9) || ".join(f"coalesce(cast({one(c)} as varchar), '')" for c in columns.split(", "))


_month = f"({_month_label('(c.fee_month - interval 1 month)')})"
_run_sheets = [
    ("Account Info", "merchant_id, merchant_name", f"select merchant_id as m, {_cells('merchant_id, merchant_name')} as cells, merchant_name as o1, '' as o2, '' as o3 from account_info"),
    ("Summary", "mp_id, mfp_created_at, txn_count, gross_volume, reversal_count, reversal_amount, revenue, total_charges",
     f"select merchant_id as m, {_cells('mp_id, mfp_created_at, txn_count, $gross_volume, reversal_count, $reversal_amount, $revenue, $total_charges')} as cells, mfp_created_at as o1, mp_id as o2, '' as o3 from by_summary"),
    ("Deposit Detail", "mp_id, mfp_created_at, mp_created_at, txn_count, txn_volume, reversal_count, reversal_amount, fees, adjusted_mp_amount",
     f"select merchant_id as m, {_cells('mp_id, mfp_created_at, mp_created_at, txn_count, $txn_volume, reversal_count, $reversal_amount, $fees, $adjusted_mp_amount')} as cells, mp_created_at as o1, mp_id as o2, mfp_created_at as o3 from by_payout"),
    ("Platform Fees", "fee_payout, created_at, amount",
     f"select merchant_id as m, {_cells('id, created_at, $amount / 100e0')} as cells, created_at as o1, id as o2, '' as o3 from mfp where status <> 'FAILED'"),
    ("Charges", "statement_year, statement_month_sort, mfp_created_at, total_charges",
     f"select merchant_id as m, {_cells('y, label, fee_month, $total')} as cells, fee_month as o1, '' as o2, '' as o3 from "
     f"(select *, year(c.fee_month - interval 1 month) as y, {_month} as label, c.cents / 100e0 as total from charged c)"),
]
_run_parts = []
for _no, (_title, _names_, _rows) in enumerate(_run_sheets, start=1):
    for _row, _text in [*_head, (7, _title), (9, _names_)]:
        _line = f"replace('{_text}', ', ', chr(9))" if _row == 9 else f"'{_text}'"
        _run_parts.append(f"select m, {_no} as section_no, '{_title}' as section, {_row} as row_no, {_line} as line from wanted")
    _run_parts.append(
        f"select r.m, {_no}, '{_title}', 9 + row_number() over (partition by r.m order by r.o1 nulls first, r.o2 nulls first, "
        f"r.o3 nulls first, r.cells), r.cells from ({_rows}) r where r.m in (select m from wanted)"
    )
CHARGED = """
charged as (
    select f.merchant_id, date_trunc('month', f.created_at) as fee_month, cast(sum(coalesce(g.amount, 0)) as bigint) as cents
    from mfp f
    left join mfpmp l on l.merchant_fee_payout_id = f.id
    left join merchant_payout q on q.id = l.merchant_payout_id
    left join mpc r on r.merchant_payout_id = q.id
    left join charge g on g.id = r.charge_id
    where f.status <> 'FAILED' group by all
)
"""
_body = lambda name: ORACLE_BODIES[name]

add(
    "statement_run_pack",
    f"""
with wanted as (select distinct merchant_id as m from account_info),
by_summary as ({_body("stmt_summary_level")}),
by_payout as ({_body("stmt_payout_level")}),
{CHARGED}
select m as merchant_id, cast(section_no as int) as section_no, section, cast(row_no as bigint) as row_no, line
from ({" union all ".join(_run_parts)})
""",
)

_run_files = r"""
named as (
    select merchant_id, regexp_replace(min(merchant_name), '[<>:"/\\|?*]', '', 'g') as base from account_info group by 1
),
files as (
    select merchant_id, base || case when count(*) over (partition by base) = 1 then '' else '_' || merchant_id end || '_Statement' as file_name,
        (row_number() over (order by merchant_id) - 1) // 10 + 1 as batch_no
    from named
)
"""

add(
    "statement_run_files",
    f"""
with {_run_files}
select merchant_id, file_name, '/run/' || file_name || '.pdf' as path, cast(batch_no as bigint) as batch_no from files
""",
)

add(
    "statement_file_names",
    r"""
with named as (
    select merchant_id, regexp_replace(min(merchant_name), '[<>:"/\\|?*]', '', 'g') as base from account_info group by 1
)
select merchant_id, base as file_base, count(*) over (partition by base) as merchants_of_name,
    base || case when count(*) over (partition by base) = 1 then '' else '_' || merchant_id end || '_Statement' as file_name
from named
""",
)

_mail = [
    ("diva", "Account Statement - A Payments", "payments@a.example", "null", "send"),
    ("divb", "Account Statement - B Payments", "payments@b.example", "'copy@b.example'", "draft"),
    ("divc", "Account Statement - C Payments", "payments@c.example", "null", "draft"),
]

add(
    "statement_dispatch_manifest",
    f"""
with mail(division, subject, sender, bcc, action) as (values {", ".join(
        f"('{d}', '{u}', '{n}', cast({b} as varchar), '{a}')" for d, u, n, b, a in _mail
    )}),
valid as (
    select r.sheet_row, r.merchant_id, r.email, r.salutation, r.attachment_path, lower(trim(r.division)) as division
    from recipients r
    where r.attachment_path in (select path from attachments)
        and contains(
            lower(trim(regexp_replace(regexp_extract(r.attachment_path, '[^/]*$'), '[^a-zA-Z0-9\\s]', '', 'g'))),
            lower(trim(regexp_replace(replace(split_part(r.salutation, ',', 1), 'Dear ', ''), '[^a-zA-Z0-9\\s]', '', 'g'))))
)
select v.sheet_row, v.merchant_id, v.email as recipient, v.division, m.subject || ' DEC 2024' as subject, m.sender, m.bcc,
    v.salutation || chr(10) || chr(10) || 'The statement of the month is attached.'
        as body,
    v.attachment_path, v.sheet_row = min(v.sheet_row) over (partition by v.division) as is_review_draft, m.action
from valid v join mail m on m.division = v.division
""",
)

add(
    "statement_run",
    f"""
with {_run_files},
mail(division, subject, sender, bcc, action) as (values {", ".join(
        f"('{d}', '{u}', '{n}', cast({b} as varchar), '{a}')" for d, u, n, b, a in _mail
    )}),
sent as (
    select r.sheet_row, r.merchant_id, r.email, replace(r.salutation, 'Shop ', 'Shop') as salutation,
        '/run/' || g.file_name || '.pdf' as attachment_path, lower(trim(r.division)) as division
    from recipients r join files g on g.merchant_id = r.merchant_id
),
valid as (
    select * from sent
    where contains(
        lower(trim(regexp_replace(regexp_extract(attachment_path, '[^/]*$'), '[^a-zA-Z0-9\\s]', '', 'g'))),
        lower(trim(regexp_replace(replace(split_part(salutation, ',', 1), 'Dear ', ''), '[^a-zA-Z0-9\\s]', '', 'g'))))
)
select v.sheet_row, v.merchant_id, v.email as recipient, v.division, m.subject || ' DEC 2024' as subject, m.sender, m.bcc,
    v.salutation || chr(10) || chr(10) || 'The statement of the month is attached.' as body, v.attachment_path,
    v.sheet_row = min(v.sheet_row) over (partition by v.division) as is_review_draft, m.action
from valid v join mail m on m.division = v.division
""",
)

add(
    "statement_batches",
    f"""
with numbered as (select id, (row_number() over (order by id) - 1) // 10 + 1 as b from merchant)
select cast(b as bigint) as batch_no, string_agg(id, ',' order by id) as merchants, count(*) as merchant_count,
    date '{s.START}' as period_start, date '{s.END}' as period_end
from numbered group by b
""",
)

add(
    "statement_run_estimate",
    """
select count(*) as merchant_count, cast(ceil(count(*) / 10) as bigint) as batch_count,
    cast(ceil(ceil(count(*) / 10) * 4.5) as bigint) as estimated_minutes
from merchant
""",
)

add(
    "address_timezone",
    """
select a.Address as "Address", z.time_zone,
    case when z.time_zone is null then 'No timezone data found for ' || a.Address
        else 'Timezone for ' || a.Address || ': ' || z.time_zone end as line
from addresses a left join address_tz z on z.place_key = a.place_key
""",
)

# --- joins ---------------------------------------------------------------------------------------------------------

add(
    "entity_hierarchy",
    f"""
with {TREE}
select mid as merchant_entity_id, mname as merchant_name, bid as business_id, bname as business_name,
    gid as business_group_id, gname as business_group_name, did as division_id, dname as division_name from tree
""",
)
add(
    "join_inner",
    """
select v.SettlementLogId as "SettlementLogId", v.ReconcileFeeId as "ReconcileFeeId", k.CoreId as "CoreId",
    k.FeeMin as "FeeMin", v.Amount as "Amount"
from settlement_log_fee v join reconcile_fee k on k.ReconcileFeeId = v.ReconcileFeeId
""",
)
add(
    "join_left",
    """
select x.id, i.contract_id, i.card_brand, c.fee_profile_id
from txn x left join payment_intent i on i.id = x.payment_intent_id left join contract c on c.id = i.contract_id
""",
)
add(
    "join_left_null_reject",
    """
select k.transaction_id, k.merchant_payout_id, f.id as fee_payout, f.status
from mpt k left join mfpmp l on l.merchant_payout_id = k.merchant_payout_id
left join mfp f on f.id = l.merchant_fee_payout_id where f.status <> 'FAILED'
""",
)
add(
    "join_coalesce_key",
    f"""
with days as (select cast(unnest(generate_series(date '{s.START}', date '{s.END}', interval 1 day)) as date) as day),
busy as (
    select activity_date as day, count(*) as reversals, 'Core Monthly' as source
    from ledger_transaction where transaction_type = 'REVERS' group by 1
),
costs as (select statement_date as day, source, sum(amount) as fees from merchant_fee group by all)
select d.day, b.reversals, coalesce(b.source, c.source) as source, cast(c.fees as decimal(28,2)) as fees
from days d left join busy b on b.day = d.day
left join costs c on c.day = d.day and coalesce(b.source, c.source) = c.source
""",
)
add(
    "join_bridge",
    """
select f.id as merchant_fee_payout_id, r.merchant_payout_id, g.id as charge_id, g.amount
from mfp f join mfpmp l on l.merchant_fee_payout_id = f.id
join mpc r on r.merchant_payout_id = l.merchant_payout_id join charge g on g.id = r.charge_id
""",
)
add(
    "lateral_sum_equi",
    """
select l.SettlementLogId as "SettlementLogId", cast((select sum(a.Amount) from remit_adjustments a
    where a.CreatedByReconcileId = l.ReconcileId and a.StoreId = l.CoreId and a.QuickbookSubcategoryId in (85, 86))
    as bigint) as "ACHAdjustments"
from settlement_log l
""",
)
add(
    "lateral_sum_range",
    f"""
select l.SettlementLogId as "SettlementLogId", cast((select sum({_money("m.TotalAmount")}) from payments m
    where m.StoreID = l.CoreId and m.PurchaseWith = 1 and cast(m.PaymentDate as date) between l.FromDate and l.ToDate)
    as decimal(27,2)) as "CardPresent"
from settlement_log l
""",
)
add(
    "join_multi_key",
    """
select l.SettlementLogId as "SettlementLogId", a.AdjustmentNo as "AdjustmentNo", a.Amount as "Amount"
from settlement_log l join remit_adjustments a
    on a.ReconcileId = l.ReconcileId and a.CoreId = l.CoreId and a.CoreTypeId = l.CoreTypeId
""",
)
add(
    "join_row_offset_range",
    f"""
select m.PaymentID as "PaymentID", m.StoreID as "StoreID", m.PaymentDate + to_hours(p.TimeOffset) as local_time
from payments m join general_prefs p on p.StoreID = m.StoreID
where m.PaymentDate >= timestamp '{s.START}' - to_hours(p.TimeOffset)
    and m.PaymentDate < timestamp '{s.CUTOFF}' + interval 1 day - to_hours(p.TimeOffset)
""",
)
add(
    "semi_join",
    """
select PaymentID as "PaymentID", StoreID as "StoreID" from payments
where StoreID in (select StoreID from stores where Deleted = 0)
""",
)
add(
    "join_config",
    f"""
with mail(division, sender) as (values {", ".join(f"('{m[0]}', '{m[2]}')" for m in _mail)})
select r.merchant_id, m.division, m.sender from recipients r join mail m on m.division = lower(trim(r.division))
""",
)
add(
    "join_calendar",
    f"""
with days as (select cast(unnest(generate_series(date '{s.START}', date '{s.END}', interval 1 day)) as date) as day)
select d.day, cast(coalesce(sum(v.amount), 0) as decimal(28,2)) as fees
from days d left join merchant_fee v on v.statement_date = d.day group by 1
""",
)
add(
    "join_composite_left",
    """
with a as (select merchant_id, date_trunc('month', created_at) as month, sum(amount) as c from mfp group by all),
b as (select merchant_id, date_trunc('month', created_at) as month, sum(amount) as c from txn group by all)
select a.merchant_id, a.month, cast(a.c as bigint) as fee_cents, cast(b.c as bigint) as txn_cents
from a left join b on b.merchant_id = a.merchant_id and b.month = a.month
""",
)

# --- aggregates ----------------------------------------------------------------------------------------------------

add(
    "agg_sum_count",
    """
select activity_date, transaction_type, cast(sum(settlement_amount) as decimal(28,2)) as settlement,
    count(*) as transactions
from ledger_transaction group by all
""",
)
add(
    "agg_count_distinct",
    """
select k.merchant_payout_id, count(distinct x.id) as txn_count, cast(sum(x.amount) as bigint) as amount_cents,
    cast(sum(if(x.type = 'REVERSAL', 1, 0)) as bigint) as reversal_count
from mpt k left join txn x on x.id = k.transaction_id group by 1
""",
)
add(
    "agg_conditional",
    """
select statement_date, cast(sum(case when source not like 'PayFac%' then amount else 0 end) as decimal(28,2)) as core,
    cast(sum(amount) filter (source like 'PayFac%') as decimal(28,2)) as vap
from merchant_fee group by 1
""",
)
add(
    "agg_case_of_agg",
    """
select date_trunc('month', created_at) as month, funding_type, cast(case funding_type when 'GROSS' then sum(gross_amount)
    when 'NET' then sum(gross_amount) - count(*) else 0 end as bigint) as amount
from merchant_payout group by 1, 2
""",
)
add(
    "agg_expr_key",
    """
select coalesce(original_transaction_id, 'none') as original,
    cast(year(created_at) as varchar) || ' - Q' || cast(quarter(created_at) as varchar) as quarter,
    count(*) as transactions
from txn group by 1, 2
""",
)
add(
    "agg_fanout_ratio",
    """
select q.id as merchant_payout_id,
    cast(sum(q.gross_amount) as bigint) / 100e0 / nullif(count(distinct k.transaction_id), 0) as adjusted
from merchant_payout q left join mpt k on k.merchant_payout_id = q.id group by 1
""",
)
add(
    "agg_decimal",
    """
select "Month", "CLUB", cast(sum(cast(Total_Fees as decimal(18,2))) as decimal(28,2)) as fees,
    cast(sum(cast(Txn_Count as int)) as bigint) as txns
from fee_lines group by 1, 2
""",
)
add(
    "agg_string_list",
    "select string_agg(FeeName, ',' order by FeeName) as fee_names from (select distinct FeeName from settlement_log_fee)",
)
add(
    "distinct_rows",
    """
select StoreId as "StoreId", RemitAdjustmentTypeId as "RemitAdjustmentTypeId", Accrual as "Accrual"
from remit_adjustments group by all
""",
)
_fee_names = (
    "CR Connect", "Corp Email", "Digital Marketing Service", "Emma", "Heart Monitor", "PCI Compliance", "Software Fee",
)
add(
    "pivot_dynamic",
    f"""
select l.CoreId as "CoreId", {", ".join(
        f'''cast(sum(v.Amount) filter (v.FeeName = '{n}') as bigint) as "{n}"''' for n in _fee_names
    )}
from settlement_log_fee v join settlement_log l on l.SettlementLogId = v.SettlementLogId group by 1
""",
)
add(
    "unpivot",
    " union all ".join(
        f"""select SettlementLogId as "SettlementLogId", '{c}' as category, {c} as amount
        from settlement_log where {c} is not null"""
        for c in ("Draft_PilTotal_Total", "Net_Total", "SalesTax_Total")
    ),
)
add(
    "multi_label_rollup",
    " union all ".join(
        f"""select activity_date, '{label}' as label, cast(sum(settlement_amount) as decimal(28,2)) as amount
        from ledger_transaction where {test} group by 1"""
        for label, test in (
            ("all", "true"),
            ("card present", "card_present = 'true'"),
            ("reversals", "transaction_type = 'REVERS'"),
            ("present credit", "card_present = 'true' and transaction_type = 'CREDIT'"),
        )
    ),
)
add(
    "global_sum",
    """
select (select cast(sum(Amount) as bigint) from settlement_log_fee where lower(FeeName) like 'heart%') as heart,
    (select cast(sum(Amount) as bigint) from settlement_log_fee where lower(FeeName) like '%9r%now%') as now
""",
)
add(
    "column_width_profile",
    """
select coalesce(nullif(group_name, ''), 'n/a') as group_name,
    cast(greatest(max(length(coalesce(nullif(merchant_id, ''), 'n/a'))), 11) + 2 as int) as merchant_id,
    cast(greatest(max(length(coalesce(nullif(contact_phone, ''), 'n/a'))), 13) + 2 as int) as contact_phone,
    cast(greatest(max(length(coalesce(cast(annual_sales_volume as varchar), 'n/a'))), 19) + 2 as int) as annual_sales_volume
from workbook_rows group by 1
""",
)
add(
    "column_width_text",
    """
select cast(greatest(max(length(merchant_id)), 11) + 2 as int) as merchant_id,
    cast(greatest(max(length(merchant_name)), 13) + 2 as int) as merchant_name
from account_info
""",
)
add(
    "group_iterate",
    """
select lower(trim(division)) as division, arg_min(email, sheet_row) as first_email, count(*) as recipients
from recipients group by 1
""",
)
add(
    "count_by_name",
    r"""
select regexp_replace(merchant_name, '[<>:"/\\|?*]', '', 'g') as name, count(*) as merchants from account_info group by 1
""",
)

# --- windows, sorts, sets ------------------------------------------------------------------------------------------

_places = """
select CASCompanyID as "CASCompanyId",
    cast(row_number() over (order by CompanyName, CASCompanyID) as decimal(17,2)) as "OrderBy" from cas_companies
"""
add("win_row_number", _places)
add(
    "win_row_number_grouped",
    "select id, row_number() over (partition by merchant_id order by created_at, id) as place from txn",
)
add(
    "win_partition_sum",
    """
select distinct StoreId as "StoreId", CoreTypeId as "CoreTypeId", Chain as "Chain",
    RemitAdjustmentTypeId as "RemitAdjustmentTypeId", Accrual as "Accrual",
    cast(sum(Amount) over (partition by StoreId, CoreTypeId, Chain, RemitAdjustmentTypeId) as bigint) as total
from remit_adjustments
""",
)
add(
    "first_per_group_flag",
    """
select sheet_row, lower(trim(division)) as division,
    row_number() over (partition by lower(trim(division)) order by sheet_row) = 1 as is_first
from recipients
""",
)
add(
    "batch_number",
    "select merchant_id, (row_number() over (order by merchant_id) - 1) // 10 + 1 as batch_no from account_info",
)
add(
    "name_unique_flag",
    r"""
with named as (select merchant_id, regexp_replace(merchant_name, '[<>:"/\\|?*]', '', 'g') as name from account_info)
select merchant_id, name in (select name from named group by 1 having count(*) = 1) as is_unique from named
""",
)
add("sort_rows", "select id, created_at, type from txn order by 2, 3, 1")
add(
    "top_1",
    """
select o.StoreID as "StoreID", p.LocationName as "LocationName" from stores o join general_prefs p on p.StoreID = o.StoreID
where o.ChainID is not null order by o.StoreID limit 1
""",
)
add(
    "sort_in_list",
    """
select CoreId as "CoreId", string_agg(distinct FeeName, ', ' order by FeeName) as fees from reconcile_fee group by 1
""",
)
add("union_all", "select id, amount, currency from txn union all select id, amount, null from charge")
add(
    "insert_append",
    f"""{_places} union all
    select * from (values (-1, 0.5), (-2, 0.4), (-3, 0.3), (-4, 0.2)) as special(g, place)""",
)

# --- expressions ---------------------------------------------------------------------------------------------------

add(
    "text_expressions",
    r"""
select a.merchant_id, lower(trim(regexp_replace(a.merchant_name, '[^a-zA-Z0-9\s]', '', 'g'))) as cleaned,
    regexp_replace(a.merchant_name, '[<>:"/\\|?*]', '', 'g') as safe,
    regexp_extract(r.attachment_path, '[^/]*$') as base, split_part(r.salutation, ',', 1) as greeting,
    regexp_extract(regexp_extract(r.attachment_path, '[^/]*$'), '^(.*)_Statement\.pdf$', 1) as captured,
    concat_ws(', ', nullif(trim(r.division), 'unknown'), r.email) as joined, upper(trim(r.division)) as division,
    cast(length(a.merchant_name) as int) as name_length, a.merchant_id || ' <' || r.email || '>' as template
from account_info a join recipients r on r.merchant_id = a.merchant_id
""",
)
add(
    "address_expressions",
    """
select StoreID as "StoreID", trim(ClubAddress) || ' ' || trim(ClubCity)
    || case when ClubState = '' then ' ' else ', ' end || trim(ClubState) || ' ' || trim(ClubZip) as address,
    case ClubState when 'Kentucky' then 'KY' when 'Texas' then 'TX' else ClubState end as state,
    LocationName like '%BRAND%' as branded
from general_prefs
""",
)
add("list_parameter", 'select StoreID as "StoreID", Status as "Status" from stores where Status in (1, 3, 9)')
_c, _d = "created_at", "cast(created_at as date)"
add(
    "list_relation",
    """
select o.StoreID as "StoreID", o.Status as "Status", cast(k.place as bigint) as place
from stores o join (values (9, 1), (1, 2), (3, 3)) k(id, place) on k.id = o.Status
""",
)

add(
    "date_expressions",
    f"""
select id, date_trunc('month', {_c}) as month_start, date_trunc('quarter', {_c}) as quarter_start,
    date_trunc('year', {_c}) as year_start, rpad(monthname({_c}), 9, ' ') as month_name,
    {_month_label(f"({_c} - interval 1 month)")} as month_before,
    strftime({_c}, '%m-%d-%Y') || ' - ' || rpad(dayname({_c}), 9, ' ') as weekday,
    cast(weekofyear({_c}) as int) as iso_week, {_us_week(_d)} as us_week,
    cast(last_day({_d}) + 1 as date) as next_month, cast({_d} - interval 1 month as date) as earlier,
    cast({_d} + 10 as date) as later, {_week_label(_c)} as week_label,
    cast(year({_c}) as varchar) || ' - ' || monthname({_c}) as month_label,
    upper(strftime({_d} - interval 1 month, '%b %Y')) as tag, {_c} - interval 5 hour as local_time
from txn
""",
)
add(
    "money_expressions",
    f"""
select PaymentID as "PaymentID", {_money("coalesce(TotalAmount, Amount)")} as amount,
    PaymentID / 100e0 / nullif(PurchaseWith - 2, 0) as ratio, cast(ceil(PaymentID / 10) as bigint) as tens,
    coalesce(TotalAmount, Amount) as shown, -PurchaseWith as negative
from payments
""",
)
add(
    "json_paths",
    """
select id, json_extract_string(configuration, '$.defaultAchFees.buyerPct') as ach,
    json_extract_string(configuration, '$.networkSpecificFees."American Express".buyerPct') as amex,
    json_extract_string(configuration, '$.networkSpecificFees') = '{}' as no_networks,
    concat_ws(', ',
        case when json_extract_string(configuration, '$.networkSpecificFees."American Express".buyerPct') is not null
            then 'American Express' end,
        case when json_extract_string(configuration, '$.networkSpecificFees.Visa.buyerPct') is not null then 'Visa' end
    ) as networks,
    try_cast(json_extract_string(configuration, '$.networkSpecificFees."American Express".merchantPct') as decimal(10,2))
        as unreadable
from fee_profile
""",
)
add(
    "filter_expressions",
    """
select o.StoreID as "StoreID", o.ChainID as "ChainID", p.clubcountry, p.ClubState as "ClubState"
from stores o left join general_prefs p on p.StoreID = o.StoreID
where o.Status in (1, 2, 7) and (p.clubcountry in ('US', 'United States') or p.clubcountry is null)
    and p.ClubState not in ('British Columbia', 'BC', 'VIC', 'PR')
    and (p.LocationName ilike 'brand_%' or p.LocationName ilike 'Club%1%') and o.CollectionsBy in (0, 1)
    and (o.ChainID <> 4 or o.ChainID is null)
""",
)
