"""The parsers on a file stream give the same rows as the batch job."""

import os

from cupola.operators.normalise import normalise_coupons
from cupola.sources.tables import coupon_view
from cupola.streaming import band_counts_stream, normalise_stream, write_stream
from tests.conftest import SF001


def test_stream_matches_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    view = coupon_view(spark, SF001)
    view.repartition(3).write.parquet(src)
    stream = normalise_stream(spark, src, view.schema, with_day=False, max_files_per_trigger=1)
    q = write_stream(stream, None, str(tmp_path / "ck"), fmt="memory", query_name="coupons_stream")
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select * from coupons_stream")
    want = normalise_coupons(view, with_day=False)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0

    bands = write_stream(band_counts_stream(normalise_stream(spark, src, view.schema, date_col=None)),
                         None, str(tmp_path / "ck2"), fmt="memory", output_mode="complete", query_name="bands")
    bands.processAllAvailable()
    bands.stop()
    total = spark.sql("select sum(n_coupons) as n from bands").first().n
    assert total == want.count()
    # every band's running counts equal the batch report's
    from cupola.operators.normalise import discount_band_report

    batch = discount_band_report(normalise_coupons(view, date_col=None)).select("band", "n_coupons", "n_redeemed")
    got_bands = spark.sql("select band, n_coupons, n_redeemed from bands")
    assert got_bands.exceptAll(batch).count() == 0 and batch.exceptAll(got_bands).count() == 0
    assert os.path.isdir(str(tmp_path / "ck"))
