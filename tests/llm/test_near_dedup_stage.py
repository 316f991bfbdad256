"""The pipeline's near-dedup stage against all pairs, and its SimHash trees against all pairs of fingerprints."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from rowtide.llm import simhash
from tests.conftest import TABLES


def shingle_set(text, size=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(found[i : i + size]) for i in range(len(found) - size + 1)) or frozenset([" ".join(found)] * bool(found))


def components_of(sets, similarity=0.8):
    """For every set the least place it is linked to; pairs are found by the shingles they share."""
    label, holders = list(range(len(sets))), {}
    for i, own in enumerate(sets):
        common = {}
        for shingle in own:
            for j in holders.setdefault(shingle, []):
                common[j] = common.get(j, 0) + 1
            holders[shingle].append(i)
        alike = [j for j, n in common.items() if n / (len(own) + len(sets[j]) - n) >= similarity]
        alike += [j for j in range(i) if not own and not sets[j]]
        for j in alike:
            low, high = sorted((label[i], label[j]))
            label = [low if x == high else x for x in label]
    return label


def test_the_stage_keeps_the_first_of_each_component_of_all_pairs(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    label = components_of([shingle_set(text) for _, text in rows])
    kept = pipeline.near_dedup(spark, docs, TABLES)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [rows[i][0] for i in sorted(set(label))]
    assert len(set(label)) < len(rows)


def test_tree_groups_are_the_components_of_all_fingerprints(spark):
    rng = random.Random(12)
    base = [rng.getrandbits(64) for _ in range(60)]
    sims = [*base]
    for k in range(240):
        sims.append(rng.choice(sims) ^ sum(1 << b for b in rng.sample(range(64), k % 7)))
    fps = np.array(sims, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    label = np.arange(len(fps))
    while not np.array_equal(new := np.array([label[row].min() for row in near]), label):
        label = new
    frame = spark.createDataFrame([(i, int(s)) for i, s in enumerate(fps.view(np.int64))], "place int, sim long")
    got = {r.place: r.group for r in simhash.tree_groups(frame, 4, 50).collect()}
    assert len({(got[i], label[i]) for i in got}) == len(set(got.values())) == len(set(label.tolist()))
