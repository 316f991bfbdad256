"""Repeated word windows against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowtide.llm import passages
from rowtide.llm.queries import QUERIES
from tests.llm.test_operators import ODD, TABLES, docs_of, documents, words


def repeated(texts, window):
    """n_words, n_removed, digest of the kept words and removed spans of every text, by counting all windows."""
    cut = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    times = Counter(tuple(w[i : i + window]) for w in cut for i in range(len(w) - window + 1))
    out = []
    for w in cut:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(frame):
    return [(r.n_words, r.n_removed, r.kept_sha256) for r in sorted(frame.collect(), key=lambda r: r.doc_id)]


def test_query_matches_brute_force(spark):
    rows = sorted((r.doc_id, r.text) for r in documents(spark).collect())
    assert rows_of(QUERIES["op11_repeated_windows"](spark, TABLES)) == repeated([t for _, t in rows], 35)


@pytest.mark.parametrize(("window", "capacity"), [(1, 1000), (2, 1000), (6, 3), (7, 1000), (35, 2)])
def test_windows_match_brute_force(spark, monkeypatch, window, capacity):
    """Small pieces, slices and vocabularies, passages at every offset, and blocks with many contexts."""
    monkeypatch.setattr(passages, "SLICE_BYTES", 2_000)
    monkeypatch.setattr(passages, "PIECE_BYTES", 300)
    rng = random.Random(window)
    shared = [words(rng, 60) for _ in range(3)]
    texts = [words(rng, rng.randrange(5)) + " " + rng.choice(shared) + "\n" + words(rng, rng.randrange(40)) for _ in range(60)]
    texts += [words(rng, 200, vocabulary=3), "a " * 150, *texts[:4], *ODD]
    assert rows_of(passages.remove_repeated_windows(docs_of(spark, *texts), window, capacity)) == repeated(texts, window)


def test_kept_texts_and_spans(spark):
    rng = random.Random(2)
    shared = words(rng, 50)
    frame = docs_of(spark, f"one two {shared} three", f"{shared} four five", ids=[1, None])
    rows = sorted(passages.remove_repeated_windows(frame, texts=True).collect(), key=lambda r: r.doc_id or 0)
    assert [(r.doc_id, r.kept, [tuple(s) for s in r.spans]) for r in rows] == [
        (None, "four five", [(0, 50)]), (1, "one two three", [(2, 50)]),
    ]


def test_odd_rows(spark):
    frame = docs_of(spark, *ODD, ids=[7, 5, 6, None, 9, 9, 3, None])
    rows = passages.remove_repeated_windows(frame).collect()
    assert Counter(r.doc_id for r in rows) == {7: 1, 5: 1, 6: 1, None: 2, 9: 2, 3: 1}
    assert {r.n_removed for r in rows if r.n_words == 2000} == {2000}
    assert passages.remove_repeated_windows(frame.limit(0)).count() == 0


def test_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(passages, "PIECE_BYTES", 50_000)
    rng = random.Random(4)
    long = words(rng, 300_000, 100_000)
    texts = [long, " ".join(long.split()[149_990:150_040]), "x" * 2_000_000]
    assert rows_of(passages.remove_repeated_windows(docs_of(spark, *texts))) == repeated(texts, 35)


def test_hot_windows_are_packed_by_slice_and_lot(spark, monkeypatch, tmp_path):
    """A passage of a great many texts is a packed row per slice and lot, and no join on its windows."""
    monkeypatch.setattr(passages, "SLICE_BYTES", 4_000)
    rng = random.Random(11)
    shared = words(rng, 60)
    texts = [f"{words(rng, 20)} {shared} {words(rng, 20)}" for _ in range(80)]
    slices = passages.stage(passages.slices(docs_of(spark, *texts), tmp_path.as_uri(), 35, 4)).where("lot is null")
    places = slices.select("slice", F.explode(F.array(F.lit(20).cast("long"), F.lit(37).cast("long"))).alias("at"))
    packed = passages.window_hashes(places, tmp_path.as_uri(), 35, 4)
    assert packed.groupBy("slice", "lot").count().where("count > 1").count() == 0
    assert packed.rdd.getNumPartitions() == 4
    found = passages.single_windows(places, tmp_path.as_uri(), 35, 4)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    # 17 words around each of the runs 20..37 and 37..54 that the first text of a slice has in common
    n = slices.count()
    assert n > 1 and found.groupBy("at").count().orderBy("at").collect() == [(at, n) for at in range(20, 38)]


def test_hot_windows_go_back_packed(spark, monkeypatch, tmp_path):
    """A passage of a great many texts is told in a row per slice and lot, however many places have it."""
    monkeypatch.setattr(passages, "SLICE_BYTES", 4_000)
    rng = random.Random(12)
    shared = words(rng, 60)
    texts = [f"{words(rng, 20)} {shared} {words(rng, 20)}" for _ in range(80)]
    frame = docs_of(spark, *texts)
    found = passages.stage(passages.repeats(frame, tmp_path.as_uri(), 35, 2))
    lots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = found.where("starts is not null")
    assert 0 < told.count() <= lots * found.where("at is null and starts is null").count()
    # no window of the passage is a row of its own: those are all of blocks with over two contexts
    assert told.agg(F.sum(F.octet_length("starts"))).first()[0] // 8 >= 80 * 26
    assert rows_of(passages.remove_repeated_windows(frame, 35, 2)) == repeated(texts, 35)


@pytest.mark.parametrize("around", [20, 0])
def test_hot_places_are_no_rows(spark, monkeypatch, tmp_path, around):
    """No table has a row a place of a block at over ``capacity`` places, be the texts around it different or copies."""
    stage, made = passages.stage, []
    monkeypatch.setattr(passages, "stage", lambda frame: made.append(stage(frame)) or made[-1])
    monkeypatch.setattr(passages, "SLICE_BYTES", 4_000)
    rng = random.Random(13)
    shared, twice = words(rng, 60), words(rng, 60)
    texts = [f"{words(rng, around)} {shared} {words(rng, around)}" for _ in range(80)] + [twice, twice]
    found = passages.repeats(docs_of(spark, *texts), tmp_path.as_uri(), 35, 10)
    blocks = [t.where("h is not null").groupBy("h").count().agg(F.max("count")).first()[0] for t in made if "h" in t.columns]
    assert 0 < max(filter(None, blocks)) <= 10
    assert found.where("at is not null").count() == 2 * 3  # the blocks of the text that is there twice
    assert rows_of(passages.remove_repeated_windows(docs_of(spark, *texts), 35, 10)) == repeated(texts, 35)


def test_windows_of_a_slice_are_packed_once(spark, tmp_path):
    """A window that a slice has many times is one hash with its number of places."""
    text = words(random.Random(14), 40)
    slices = passages.stage(passages.slices(docs_of(spark, *[text] * 50).coalesce(1), tmp_path.as_uri(), 35, 4)).where("lot is null")
    places = slices.select("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1999).cast("long"), F.lit(40).cast("long"))).alias("at"))
    packed = passages.window_hashes(places, tmp_path.as_uri(), 35, 4)
    # at word 0 of each text only the window that begins there holds the block
    assert [(len(r.sigs), r.times, len(r.places)) for r in packed.collect()] == [(16, (50).to_bytes(4, "little"), 400)]
    found = passages.single_windows(places, tmp_path.as_uri(), 35, 4)
    assert sorted(r.at for r in found.collect()) == list(range(0, 2000, 40))
