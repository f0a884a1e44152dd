"""The driver's tables in their booking roles, the registered queries and their SQL partners."""
