"""Parameters of the registered queries; the oracles use the same values."""

import datetime as dt

from tallywright.plans.documents import DispatchConfig, DivisionMail
from tallywright.plans.franchise import FranchiseParams
from tallywright.plans.stores import StoreParams

START, END = dt.date(1995, 1, 1), dt.date(2001, 12, 31)
CHARGES_AFTER = dt.date(2024, 1, 15)
EXCLUDED_MERCHANTS = ("mer_10", "mer_20", "mer_30")
ACCOUNTS = {"div_0": "First Operating Account", "div_1": "First Operating Account", "div_3": "Second Operating Account"}
DIVISIONS = ("div_0", "div_1", "div_2", "div_3")
CUTOFF = dt.date(2000, 7, 1)
REPORT_DATE = dt.date(2001, 3, 31)
AS_OF = dt.datetime(1995, 3, 1, 12, 0, 0)
TODAY = dt.date(2025, 1, 15)

REMIT = StoreParams(remit_groups="all", mixed_chain_id=6, region_mode=2, club_states=None)
BRAND = StoreParams(brand_ids="all", mixed_chain_id=6, skipped_chain_ids=(2,))
FRANCHISE = FranchiseParams(start=START, end=END)

DISPATCH = DispatchConfig(
    body="The statement of the month is attached.",
    divisions={
        "diva": DivisionMail("Account Statement - A Payments", "payments@a.example", send=True),
        "divb": DivisionMail("Account Statement - B Payments", "payments@b.example", bcc="copy@b.example"),
        "divc": DivisionMail("Account Statement - C Payments", "payments@c.example"),
    }
)

FEE_CATEGORY_NAMES = ("CorporateFee", "SoftwareFee", "PCIFee", "ConnectFee")
