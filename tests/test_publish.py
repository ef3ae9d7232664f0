"""Publishing once, with an outcome per message (M3)."""

import os
from contextlib import contextmanager

import pytest

from starweave.streaming import drain as D
from starweave.streaming import publish as PB


def flaky(path, bad):
    """A folder sink that refuses the messages in ``bad``."""
    inner = PB.folder_sink(path)

    @contextmanager
    def opened():
        with inner() as send:

            def some(value, key):
                if value.decode() in bad:
                    raise ConnectionError(f"no route for {value.decode()}")
                return send(value, key)

            yield some

    return opened


def lines(path):
    return sorted(x for f in os.listdir(path) for x in open(os.path.join(path, f)).read().splitlines())


def text(df):
    return df.select(df.value.cast("binary").alias("value"))


def frame(spark, n=200, parts=4):
    return spark.createDataFrame([(f"m{i}",) for i in range(n)], "value string").repartition(parts)


def test_retry_sends_only_what_failed(spark, tmp_path):
    topic, ledger = str(tmp_path / "topic"), str(tmp_path / "ledger")
    bad = {f"m{i}" for i in range(0, 200, 7)}
    first = PB.publish_each(frame(spark), flaky(topic, bad), ledger, payload=text, task_rows=30).collect()
    assert len(first) == 200 and sum(r.reply == "N" for r in first) == len(bad)
    assert {r.value.decode() for r in PB.failed(spark, ledger).collect()} == bad
    assert all("no route for m" in r.detail for r in PB.failed(spark, ledger).collect())
    again = PB.publish_each(frame(spark), PB.folder_sink(topic), ledger, payload=text).collect()
    assert {r.reply for r in again} == {"Y"} and {r.attempt for r in again} == {1, 2}
    assert lines(topic) == sorted(f"m{i}" for i in range(200))  # each once
    PB.publish_each(frame(spark), PB.folder_sink(topic), ledger, payload=text)  # nothing left to send
    assert len(lines(topic)) == 200 and PB.failed(spark, ledger).count() == 0


def test_a_run_that_dies_half_way_goes_on(spark, tmp_path):
    topic, ledger, flag = str(tmp_path / "topic"), str(tmp_path / "ledger"), str(tmp_path / "flag")
    inner = PB.folder_sink(topic)

    def dying():
        if os.path.exists(flag):  # the task that opens the sink second, and its retries
            raise SystemError("lost")
        open(flag, "w").close()
        return inner()

    with pytest.raises(Exception, match="lost"):
        PB.publish_each(frame(spark, parts=1), dying, ledger, payload=text, task_rows=50)
    before = lines(topic)
    assert 0 < len(before) < 200
    out = PB.publish_each(frame(spark), PB.folder_sink(topic), ledger, payload=text)
    assert {r.reply for r in out.collect()} == {"Y"} and out.count() == 200
    after = lines(topic)
    assert sorted(set(after)) == sorted(f"m{i}" for i in range(200)) and len(after) <= 200 + len(before)


def test_attempts_within_a_run(spark, tmp_path):
    out = PB.publish_each(frame(spark, 20), flaky(str(tmp_path / "t"), {"m3"}), str(tmp_path / "l"), payload=text, attempts=3)
    assert {(r.reply, r.attempt) for r in out.collect()} == {("Y", 1), ("N", 3)}
    assert len(lines(str(tmp_path / "t"))) == 19


def test_stream_batch_is_taken_up_again(spark, tmp_path):
    src, topic, ledger, ckpt = (str(tmp_path / x) for x in ("in", "topic", "ledger", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "a.txt"), "w") as f:
        f.write("one\ntwo\nthree\n")

    def stream():
        return D.message_stream(spark, src, None, fmt="text")

    bad = PB.publish_each(stream(), flaky(topic, {"two"}), ledger, payload=text, checkpoint=ckpt)
    assert sorted(r.reply for r in bad.collect()) == ["N", "Y", "Y"] and lines(topic) == ["one", "three"]
    with open(os.path.join(src, "b.txt"), "w") as f:
        f.write("four\n")
    good = PB.publish_each(stream(), PB.folder_sink(topic), ledger, payload=text, checkpoint=ckpt)
    assert {r.reply for r in good.collect()} == {"Y"} and lines(topic) == sorted(["one", "two", "three", "four"])
    with pytest.raises(ValueError):
        PB.publish_each(stream(), PB.folder_sink(topic), ledger)


def test_rows_as_json_and_no_rows(spark, tmp_path):
    topic = str(tmp_path / "topic")
    PB.publish_each(spark.createDataFrame([(1, "é")], "id long, v string"), PB.folder_sink(topic), str(tmp_path / "l"))
    assert lines(topic) == ['{"id":1,"v":"é"}']
    none = PB.publish_each(frame(spark, 1).limit(0), PB.folder_sink(topic), str(tmp_path / "l0"), payload=text)
    assert none.collect() == []
