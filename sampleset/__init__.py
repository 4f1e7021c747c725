"""Every operator of the engine as a query over the sample tables, with its check in SQL."""
