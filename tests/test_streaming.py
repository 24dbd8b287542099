"""Incremental key updates from a landing folder (availableNow stream)."""
from linkwright.sources.publish import publish, read_current
from linkwright.streaming.landing import apply_landing_updates
from conftest import rows


def test_landing_updates_apply_once(spark, tmp_path):
    base, landing, ckpt = (str(tmp_path / n) for n in ("tasks", "landing", "ckpt"))
    publish(spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "Id long, What_Id long"), base, "v0")
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.csv").write_text("Id,What_Id\n1,11\n2,abc\n")
    apply_landing_updates(spark, landing, base, "Id", ["What_Id"], ckpt).awaitTermination()
    assert rows(read_current(spark, base)) == [(1, 11), (2, None), (3, 30)]
    # a second run only sees new files
    (tmp_path / "landing" / "b.csv").write_text("Id,What_Id\n3,33.5\n")
    apply_landing_updates(spark, landing, base, "Id", ["What_Id"], ckpt).awaitTermination()
    assert rows(read_current(spark, base)) == [(1, 11), (2, None), (3, 34)]
