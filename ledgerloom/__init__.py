"""ledgerloom — a personal-ledger lakehouse expressed as Spark DataFrame jobs.

Bronze statements and exports land as tables; silver builds the account
dimension, the categorised transaction fact and transfer matching; gold
serves spending, cash flow, net worth, completeness and quality alerts.
"""

__all__ = ["session"]
