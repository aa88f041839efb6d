"""Sinks and sources (S03, S04, S08-S12) and the streaming apply."""

import os
import uuid

from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.roles import Roles
from tessera.session import checkpoint_dir
from tessera.sources import io as IO
from tessera.sources.bank import bank_test, bank_train
from tessera.streaming.apply import clean_stream

SF = "/root/testdata/sf0.001"


def _tmp(spark, name):
    return os.path.join(checkpoint_dir(spark), "tests", uuid.uuid4().hex, name)


def test_params_and_kept_log_round_trip(spark):
    tr = bank_train(spark, SF)
    st = C.fit_clean(tr, Roles())
    p = _tmp(spark, "params")
    IO.save_params(C.params_frame(spark, st), p)
    back = IO.load_params(spark, p)
    assert back.where(F.col("operator") == "standardize").count() == 2 * len(st.scale)
    log = IO.kept_columns_log(spark, 1, "reduction", "corr", "0.99", ["a", "b"])
    assert [r["column_name"] for r in log.orderBy("pos").collect()] == ["a", "b"]


def test_export_reports(spark):
    folder = _tmp(spark, "bi")
    tr = bank_train(spark, SF)
    out = IO.export_reports({"train": tr.limit(5), "counts": tr.groupBy("y").count()}, folder)
    assert len(out) == 2 and IO.read_csv(spark, out[0]).count() == 5


def test_require_columns(spark):
    import pytest
    from tessera.roles import require_columns
    with pytest.raises(ValueError):
        require_columns(bank_test(spark, SF), ["y"], "test")


def test_stream_apply_equals_batch(spark):
    tr, te = bank_train(spark, SF), bank_test(spark, SF)
    st = C.fit_clean(tr, Roles())
    src = _tmp(spark, "incoming")
    te.write.parquet(src)
    stream = spark.readStream.schema(te.schema).parquet(src)
    name = "s" + uuid.uuid4().hex[:8]
    q = (clean_stream(stream, st).writeStream.format("memory").queryName(name)
         .option("checkpointLocation", _tmp(spark, "ckpt")).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table(name).orderBy("id").toPandas()
    want = C.apply_clean(te, st).orderBy("id").toPandas()
    assert got.equals(want)


def test_warehouse_refresh(spark):
    loc = _tmp(spark, "warehouse")
    db = "w" + uuid.uuid4().hex[:8]
    tr, te = bank_train(spark, SF), bank_test(spark, SF)
    out = IO.refresh_warehouse(spark, tr, te, database=db, location=loc)
    assert out == [f"{db}.train", f"{db}.test"]
    assert spark.table(f"{db}.train").count() == tr.count()
    IO.refresh_warehouse(spark, tr.limit(3), None, database=db, location=loc)
    assert spark.table(f"{db}.train").count() == 3


def test_drop_materialized_removes_written_tables(spark):
    import os
    from tessera.session import drop_materialized, materialize
    t = materialize(spark.range(10).toDF("id"), "probe")
    path = t.inputFiles()[0].replace("file:", "")
    assert os.path.exists(path)
    assert t.count() == 10
    assert drop_materialized(spark) >= 1
    assert not os.path.exists(path)


def test_warehouse_refresh_never_shows_an_empty_table(spark, tmp_path):
    """A second refresh whose write fails leaves both old tables; the next one replaces them and keeps one old version."""
    import os
    import pytest
    from pyspark.sql import functions as F
    from tessera.sources import io as IO
    db = f"swap_{os.path.basename(str(tmp_path)).replace('-', '_')}"
    old = spark.range(10).withColumn("v", F.lit(1))
    at = dict(database=db, location=f"file://{tmp_path}/db")
    IO.refresh_warehouse(spark, old, old, **at)
    broken = spark.range(10).withColumn("v", F.when(F.col("id") >= 0, F.raise_error(F.lit("lost"))).cast("int"))
    with pytest.raises(Exception, match="lost"):
        IO.refresh_warehouse(spark, old.withColumn("v", F.lit(2)), broken, **at)
    assert spark.table(f"{db}.train").agg(F.sum("v")).first()[0] == spark.table(f"{db}.test").agg(F.sum("v")).first()[0] == 10
    for v in (3, 4):
        IO.refresh_warehouse(spark, old.withColumn("v", F.lit(v)), old, **at)
    assert spark.table(f"{db}.train").agg(F.sum("v")).first()[0] == 40
    assert len([d for d in os.listdir(f"{tmp_path}/db/test.versions")]) == 2
    IO.refresh_warehouse(spark, old.withColumn("extra", F.lit("x")), None, **at)
    assert spark.table(f"{db}.train").columns == ["id", "v", "extra"] and spark.table(f"{db}.test").count() == 10
    spark.sql(f"DROP DATABASE {db} CASCADE")
