from tallywright.plans import documents, fees, franchise, ledgers, statements, stores

__all__ = ["documents", "fees", "franchise", "ledgers", "statements", "stores"]
