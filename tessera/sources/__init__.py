from tessera.sources.extract import read_table, tables  # noqa: F401
