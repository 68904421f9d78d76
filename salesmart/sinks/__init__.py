from salesmart.sinks.writers import (
    SWAP,
    Writer,
    execute,
    save_all,
    to_database,
    to_folder,
    write_csv,
    write_jdbc,
    write_parquet,
    write_typed_table,
)

__all__ = [
    "SWAP", "Writer", "execute", "save_all", "to_database", "to_folder",
    "write_csv", "write_jdbc", "write_parquet", "write_typed_table",
]
