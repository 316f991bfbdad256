"""Slices of texts for the encoder."""

from __future__ import annotations

import pyarrow as pa

from rowtide.llm import token_files
from rowtide.llm.queries import tokenizer_path


def test_slices_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 10)
    texts = ["", None, "a" * 4, "b" * 6, "c", "d" * 30, "", "e" * 11, "f"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["doc_id", "text"])
    slices = [s.column(1).to_pylist() for s in token_files._slices(batch)]
    assert sum(slices, []) == texts and len(slices) > 3
    # a text beyond the limit shares its slice with empty ones at most
    assert all(sum(map(bool, s)) == 1 or sum(len(t or "") for t in s) <= 10 for s in slices)
    empty = list(token_files._slices(batch.slice(0, 0)))
    assert [s.num_rows for s in empty] == [0]


def test_texts_are_encoded_alike_alone_and_together():
    encoder = token_files.WordEncoder(tokenizer_path(), 2)
    texts = ["", None, " ", "One, two. Three", "ÉTÉ naïve", "日本語 text, mixed.", "a\nb  c", "x" * 300, "🙂 ok", "\x00 \x1f"]
    whole = lambda t: encoder._bytes(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids) + encoder.end
    assert encoder.encode(texts) == [encoder.encode([t])[0] for t in texts] == [whole(t) for t in texts]
    assert encoder.encode([]) == []
