from tallywright.registry.oracles import ORACLES
from tallywright.registry.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
