"""the ranges of files are read by several tasks, and not by one because their rows are few."""

from pyspark.sql import functions as F

from kelpline.operators import validate as V
from kelpline.sources import bounded_csv

HEAD = ",".join(f.name for f in V.CONTRACTS["category_translation"].fields)


def test_ranges_are_read_by_several_tasks(spark, tmp_path):
    for i in range(6):
        (tmp_path / f"{i}.csv").write_text(HEAD + "\n" + "".join(f"a{i}-{k},b\n" for k in range(500)))
    rows = bounded_csv.range_records(spark, f"file://{tmp_path}", V.CONTRACTS["category_translation"], range_bytes=1000)
    by_task = rows.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in by_task) == 3000
    assert len(by_task) > 8 and max(r["count"] for r in by_task) < 750
