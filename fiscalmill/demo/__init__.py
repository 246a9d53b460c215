"""The library's queries over the generated test tables, with SQL oracles."""
