"""Every operator run on the shared test tables, with the SQL that must agree."""
