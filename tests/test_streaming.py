"""FX payload stream: file source -> foreachBatch keyed upsert."""

import os

from fundlens.streaming.fx_stream import start_fx_payload_stream


def _write(d, name, text):
    with open(os.path.join(d, name), "w") as f:
        f.write(text + "\n")


def test_stream_upserts_and_corrects(spark, tmp_dir):
    payloads = os.path.join(tmp_dir, "in")
    os.makedirs(payloads)
    table = os.path.join(tmp_dir, "fx")
    ckpt = os.path.join(tmp_dir, "ckpt")
    _write(payloads, "a.json", '{"rates": {"THB": 35.0, "USD": 1.0, "EUR": 0.875}, "time_last_update_unix": 1704110400}')
    q = start_fx_payload_stream(spark, payloads, table, ckpt, symbols="USD,EUR")
    q.awaitTermination()
    got = {r.from_ccy: r.rate_to_thb for r in spark.read.parquet(table).collect()}
    assert got == {"THB": 1.0, "USD": 35.0, "EUR": 40.0}
    # late correction of the same date replaces the stored rates
    _write(payloads, "b.json", '{"rates": {"THB": 36.0, "USD": 1.0}, "time_last_update_unix": 1704114000}')
    q = start_fx_payload_stream(spark, payloads, table, ckpt, symbols="USD,EUR")
    q.awaitTermination()
    got = {r.from_ccy: r.rate_to_thb for r in spark.read.parquet(table).collect()}
    assert got == {"THB": 1.0, "USD": 36.0, "EUR": 40.0}
