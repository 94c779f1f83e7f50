import io
import zlib

import numpy as np
import pytest

from quayside.llm import token_files as tf
from quayside.session import new_run_dir
from tests.llm.conftest import awkward_rows, frame, prose


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (5, 300), (511, 60_000), (512, 200), (3000, 2**31), (2000, 255), (1025, 70_000)])
def test_codes_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    starts = np.array([0, n // 3, n // 3, n])
    out = io.BytesIO()
    tf.write_shard(out, ids, starts, [5, None, -7])
    shard = tf.Shard(out.getvalue())
    assert (shard.n_tokens, shard.n_docs, shard.doc_ids) == (n, 3, [5, None, -7])
    assert shard.range(0, n).tolist() == ids.tolist()
    assert [shard.token(k) for k in range(0, n, 7)] == ids[::7].tolist()
    for a, b in ((0, 0), (n // 2, n), (n // 4, n // 2), (n, n)):
        assert shard.range(a, b).tolist() == ids[a:b].tolist()
    assert [len(shard.document(k)) for k in range(3)] == [n // 3, 0, n - n // 3]
    for at_once in (1, n // 3 + 1, 1 << 20):
        assert [bytes(d) for d in shard.documents(at_once)] == [shard.document(k).astype("<u4").tobytes() for k in range(3)]
    with pytest.raises(IndexError):
        shard.range(0, n + 1)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tf.default_tokenizer())


def test_words_encode_as_whole_texts_do(tokenizer):
    texts = [r[1] or "" for r in awkward_rows() if len(r[1] or "") < 20_000] + [
        "Don't you'LL we've it'S 's 'tis", "A.B,C;D!!! (x) [y] {z} #$% &&& ***", "ÀÉÎ ÿ Œ ß ẞ İ ı Å Å éx", "日本語 テスト 한국어 עברית",
        "a b c d　e \x1c \x85 x", "12 345 6a7 ½ ² Ⅷ", "x_y __ _a_ a-b--c", "<|startoftext|>hi<|endoftext|> <|x|>", "​ ﻿ \u0000 \x7f", "µ ª º ƒ Ǆ ǅ",
    ]
    words = tf.WordIds(tokenizer.to_str(), tf.END_ID)
    data = [t.encode() for t in texts]
    offs = np.concatenate(([0], np.cumsum([len(d) for d in data]))).tolist()
    for _ in range(2):  # the second time from memory
        ids, starts = words.ids(b"".join(data), offs)
        for k, t in enumerate(texts):
            assert ids[starts[k] : starts[k + 1]].tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, tf.END_ID], t


def test_forgetting_changes_nothing(tokenizer):
    data = prose(9, 500).encode()
    big, small = tf.WordIds(tokenizer.to_str(), tf.END_ID), tf.WordIds(tokenizer.to_str(), tf.END_ID, most=10)
    for _ in range(3):
        a, b = (w.ids(data, [0, 100, len(data)])[0].tolist() for w in (big, small))
        assert a == b


def test_files_in_ascending_order(spark, tokenizer, monkeypatch):
    rows = awkward_rows() + [(1000 - k, prose(k, 20), "en", "a", 0) for k in range(50)]
    out = tf.token_output(frame(spark, rows), folder=new_run_dir(spark, "tokens")).collect()
    want = {}
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, tf.END_ID]
        want.setdefault(r[0], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], []).append((r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    order = sorted(out, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    at = 0
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]


def test_empty_table(nothing):
    assert tf.token_output(nothing).collect() == []
