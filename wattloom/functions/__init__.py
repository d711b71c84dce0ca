"""Column functions: dates and days, units, text parsing, repeatable draws."""
