"""Files that come later: the newest file of a lot, bucket by bucket."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import keys as K
from tenderlake.plans import build, deltas
from tenderlake.sources import versions as V

FILES = ["delta_202604.csv", "delta_202605.csv", "delta_2026041.csv", "00-full.csv"]


def rows_of(df, *names):
    return sorted(map(repr, map(tuple, df.select(*names).collect())))


def text(spark, rows):
    return spark.createDataFrame(rows, f"cig string, v int, {K.SOURCE} string")


def made(seed, n=400):
    rng = random.Random(seed)
    lots = [f"L{i}" for i in range(60)] + [" L1", None, ""]
    return [(rng.choice(lots if f == "00-full.csv" else lots[:25] + lots[-3:]), k, f)
            for k in range(n) for f in [rng.choice(FILES)]]


def newest(rows):
    top = {}
    for lot, _, f in rows:
        top[lot] = max(top.get(lot, ""), f)
    return sorted(repr((lot, v)) for lot, v, f in rows if f == top[lot])


def test_whole_names_decide(spark):
    """Names that agree in any number of leading characters."""
    rows = made(1)
    df = text(spark, rows)
    assert rows_of(K.keep_newest_source(df), "cig", "v") == newest(rows)
    placed = deltas.ordered(df, deltas.orders(FILES))
    assert rows_of(K.keep_newest_source(placed), "cig", "v") == newest(rows)
    plan = K.keep_newest_source(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "SortAggregate" not in (
        K.keep_newest_source(placed)._jdf.queryExecution().executedPlan().toString()
    )


def test_places_follow_names():
    places = deltas.orders(["b", "d"])
    more = deltas.orders(["a", "c", "e", "cc"], places)
    assert sorted(more, key=more.get) == sorted(more) and all(more[n] == places[n] for n in places)
    tight = {"a": 1, "b": 2}
    with pytest.raises(ValueError, match="no place left"):
        deltas.orders(["aa"], tight)


@pytest.mark.parametrize("order", [[3, 0, 1, 2], [1, 3, 2, 0], [0, 1, 2, 3]])
def test_files_added_in_any_order_equal_a_rebuild(spark, tmp_path, order):
    rows, path = made(2), str(tmp_path / "live")
    for k in order:
        own = [r for r in rows if r[2] == FILES[k]]
        deltas.keep(spark, path, deltas.add(text(spark, own), path, [FILES[k]], buckets=16))
    assert rows_of(deltas.live(spark, path), "cig", "v") == newest(rows)
    with pytest.raises(ValueError, match="already part"):
        deltas.add(text(spark, rows[:1]), path, [FILES[0]])


def test_untouched_buckets_are_never_read(spark, tmp_path):
    path = str(tmp_path / "live")
    full = [(f"L{i}", i, "00-full.csv") for i in range(200)]
    deltas.keep(spark, path, deltas.add(text(spark, full), path, ["00-full.csv"], buckets=16))
    before = {r["part"]: r["folder"] for r in V.current(spark, path)}
    assert len(before) == 16
    lot = [("L7", 1000, "01-delta.csv")]
    (own,) = {r[0] for r in text(spark, lot).select(deltas.bucket_of(F.col("cig"), 16)).collect()}
    # Nobody can read the other buckets any more.
    for part, folder in before.items():
        if part != own:
            for file in (tmp_path / "live/data" / folder).glob("*.parquet"):
                file.write_bytes(b"spoiled")
            for crc in (tmp_path / "live/data" / folder).glob(".*.crc"):
                crc.unlink()
    change = deltas.add(text(spark, lot), path, ["01-delta.csv"], buckets=16)
    assert change.buckets == [own]
    deltas.keep(spark, path, change)
    after = {r["part"]: r["folder"] for r in V.current(spark, path)}
    assert {p for p in after if after[p] != before[p]} == {own}
    got = {r["cig"]: r["v"] for r in V.read_version(spark, path, parts=[own]).collect()}
    assert got["L7"] == 1000 and all(v < 200 for lot, v in got.items() if lot != "L7")
    # A file older than all that is held touches nothing.
    late = deltas.add(text(spark, [("L7", 5, "00-early.csv")]), path, ["00-early.csv"], buckets=16)
    assert late.buckets == [] and late.staged is None


def test_an_adding_that_was_broken_off_is_done_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "live")
    deltas.keep(spark, path, deltas.add(text(spark, [("A", 1, "00"), ("B", 2, "00")]), path, ["00"]))
    change = deltas.add(text(spark, [("A", 3, "01")]), path, ["01"])
    with monkeypatch.context() as broken:
        broken.setattr(V, "publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            deltas.keep(spark, path, change)
    assert rows_of(deltas.live(spark, path), "cig", "v") == ["('A', 1)", "('B', 2)"]
    deltas.keep(spark, path, deltas.add(text(spark, [("C", 9, "02")]), path, ["02"]))
    deltas.keep(spark, path, deltas.add(text(spark, [("A", 3, "01")]), path, ["01"]))
    assert rows_of(deltas.live(spark, path), "cig", "v") == ["('A', 3)", "('B', 2)", "('C', 9)"]


def test_feed_of_files(spark, tmp_path):
    """Months added to a feed give the tables of a build from all files."""
    head = "cig;id_aggiudicazione;data_aggiudicazione_definitiva;importo_aggiudicazione\n"
    months = {
        "00-full.csv": "A;1;2024-01-01;10\nA;2;2024-01-01;20\nB;3;2024-05-01;5\n C;4;2024-01-01;7\nD;5;2024-01-01;8\n",
        "delta_202604.csv": "A;1;2024-02-01;30\nD;5;1801-01-01;9\n",
        "delta_202605.csv": "A;1;2024-02-01;31\nA;9;2024-02-01;32\nE;6;2024-02-01;1\n",
    }
    files = []
    for name, lines in months.items():
        (tmp_path / name).write_text(head + lines)
        files.append(str(tmp_path / name))
    whole = build.build_dataset(spark, "aggiudicazioni", files, str(tmp_path / "whole"), check=False)
    out = str(tmp_path / "out")
    build.add_files(spark, "aggiudicazioni", files[:1], out, check=False)
    for file in files[1:]:
        tables = build.add_files(spark, "aggiudicazioni", [file], out, check=False)
    names = ["cig", "id_aggiudicazione", "importo_aggiudicazione"]
    assert tables["clean"].columns == whole["clean"].columns
    assert rows_of(tables["clean"], *names) == rows_of(whole["clean"], *names)
    # The row of D in the month has no plausible day: it does not compete.
    assert "('D', 5, 8.0)" in rows_of(tables["clean"], *names)
    for name in ("mart_annuale", "mart_dettaglio"):
        assert rows_of(build.read_table(spark, out, "mart", "aggiudicazioni", name), "*") == rows_of(whole[name], "*")
    with pytest.raises(ValueError, match="lot by lot"):
        build.add_files(spark, "cup", files, out)


def test_rows_are_exchanged_where_they_may_go_only(spark, tmp_path):
    """A first file goes to its buckets as it comes; a newest one meets the older rows only."""
    path = str(tmp_path / "live")
    first = deltas.add(text(spark, [("A", 1, "00"), ("B", 2, "00"), (None, 3, "00")]), path, ["00"], buckets=4)
    assert not (tmp_path / "live/arrived").exists()
    deltas.keep(spark, path, first)
    newest = deltas.add(text(spark, [("A", 4, "02"), (None, 5, "02")]), path, ["02"], buckets=4)
    assert len(newest.staged.parts) == len(newest.buckets)
    deltas.keep(spark, path, newest)
    between = deltas.add(text(spark, [("A", 6, "01"), ("B", 7, "01"), ("C", 8, "01")]), path, ["01"], buckets=4)
    deltas.keep(spark, path, between)
    want = [("A", 4), ("B", 7), ("C", 8), (None, 5)]
    assert rows_of(deltas.live(spark, path), "cig", "v") == sorted(map(repr, want))
    assert deltas.add(text(spark, []), path, ["03"], buckets=4).staged is None


def test_few_parts_are_written_without_an_exchange(spark, tmp_path, monkeypatch):
    asked = []
    stage = V.stage
    monkeypatch.setattr(V, "stage", lambda *a, **b: asked.append(b.get("rebalanced")) or stage(*a, **b))
    for name, buckets in (("few", 8), ("many", 64)):
        path = str(tmp_path / name)
        deltas.add(text(spark, [(f"L{i}", i, "00") for i in range(300)]), path, ["00"], buckets=buckets)
    assert asked == [True if n > deltas.FEW else False for n in (8, 64)]
    rows = spark.range(40).selectExpr("id", "cast(id % 2 AS string) AS y").repartition(3)
    few = V.stage(rows, str(tmp_path / "t"), "y", rebalanced=False)
    assert few.parts == ("0", "1") and few.rows.count() == 40
