"""Writers: partitioned Parquet layers, managed / external tables, inventory."""

from tradeflow.sinks.files import external_table_ddl, partition_inventory, write_layer, write_table

__all__ = ["external_table_ddl", "partition_inventory", "write_layer", "write_table"]
