"""Writing tables to files and databases."""

from .batches import write_batch, write_feed
from .files import write_batches, write_csv, write_parquet
from .jdbc import write_jdbc
from .single import write_one_csv

__all__ = ["write_batch", "write_batches", "write_csv", "write_feed", "write_jdbc", "write_one_csv", "write_parquet"]
