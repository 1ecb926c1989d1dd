"""Every operator as a query over the given tables, next to SQL that says the same."""
