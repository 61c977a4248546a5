"""Scratch tables go where the caller can delete them."""

import pytest

from millrace.operators import cdc as ops
from millrace.session import scratch, scratch_path, shared_folder
from millrace.specs import Cdc
from test_cdc import frame, random_feed


def left(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/millrace")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def test_a_block_leaves_nothing(spark, tmp_path):
    before = left(spark)
    cdc = Cdc(["k"], "seq", 2, apply_as_deletes="op = 'D'", except_column_list=["op"])
    with scratch(spark) as folder:
        ops.scd2(frame(spark, random_feed(5, rows=600)), cdc, 50).write.parquet(str(tmp_path / "out"))
        assert scratch_path(spark, "x").startswith(folder)
        with scratch(spark) as inner:
            assert scratch_path(spark, "x").startswith(inner) and inner != folder
        assert [n for n in left(spark) if n not in before] == [folder.rsplit("/", 1)[1]]
    assert left(spark) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0
    with pytest.raises(RuntimeError), scratch(spark) as folder:
        spark.range(1).write.parquet(scratch_path(spark, "x"))
        raise RuntimeError("stop")
    assert left(spark) == before and not scratch_path(spark, "x").startswith(folder)
