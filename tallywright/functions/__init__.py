from tallywright.functions import dates, filters, money, text

__all__ = ["dates", "filters", "money", "text"]
