"""Every operator as a query over the sample tables, next to its SQL counterpart."""
