"""Price histories of scraped products as PySpark DataFrame operators.

The library ingests landed CSV files and page tables, cleans their text
columns, keeps tables current by watermark, models them as a star schema and
answers price analytics and data-quality checks. Every function takes and
returns DataFrames or Columns; nothing here reads the clock unless ``as_of``
is left out, and no data row passes through the driver.
"""

from shelftrack.session import build_session, prepare

__all__ = ["build_session", "prepare"]
