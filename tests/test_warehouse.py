"""The warehouse route loads the same tables as the tables route, and can run
again over its own tables (imports overwrite, empty-only loads follow a
truncate)."""

import os
import uuid

from starweave.plans import routes as RT

SMALL = "/root/testdata/sf0.001"


def test_warehouse_route_equals_tables_route(spark, tmp_path):
    csv = str(tmp_path / "csv")
    RT.export_source_csv(spark, SMALL, csv)
    tabs = RT.run_tables_route(spark, csv, str(tmp_path / "work"))
    db = f"wh_{uuid.uuid4().hex[:6]}"
    wh = RT.run_warehouse_route(spark, csv, db)
    wh = RT.run_warehouse_route(spark, csv, db)  # a second run over the loaded tables
    for name, table in wh.items():
        a = spark.table(table)
        b = spark.read.parquet(os.path.join(str(tmp_path / "work"), name)).select(*a.columns)
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
