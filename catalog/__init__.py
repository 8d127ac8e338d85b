"""Every operator as a query over the test tables, with its twin in SQL."""
