"""DuckDB session with the driver's tables registered as views (local checks)."""
import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con
