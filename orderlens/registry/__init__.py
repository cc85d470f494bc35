"""Every operator as a named query over the test tables, with the SQL it must agree with."""
