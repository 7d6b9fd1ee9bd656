"""Separator scan against a plain loop, and the counts against the tokenizers library."""

import numpy as np
import pytest
from conftest import SF_ORACLE

from vaultlens.llm.token_files import listed_files, op1_token_counts, scan_token_files, token_counts
from test_bpe import PATH


def plain_scan(ids, end):
    out, start = [], 0
    for i, t in enumerate(ids):
        if t == end:
            out.append((len(out), start, i - start, True))
            start = i + 1
    if start < len(ids):
        out.append((len(out), start, len(ids) - start, False))
    return out


@pytest.mark.parametrize("width,block", [(2, 7), (4, 7), (2, 1), (4, 1 << 20)])
def test_scan_matches_plain_loop(spark, tmp_path, width, block):
    rng = np.random.default_rng(width * block)
    files = {"a": rng.integers(0, 6, 200), "b": np.array([3]), "c": np.array([5]), "d": np.full(30, 3), "e": np.arange(100, 150),
             "f": np.array([], dtype=int), "g": np.concatenate([np.full(40, 9), [3], np.full(40, 9)])}
    for name, ids in files.items():
        ids.astype(f"<u{width}").tofile(tmp_path / f"{name}.tokens")
    got = {}
    for r in scan_token_files(listed_files(spark, str(tmp_path)), 3, width, block).collect():
        got.setdefault(r.file[-8], []).append((r.doc_no, r.first_token, r.n_tokens, r.ended))
    assert {k: sorted(v) for k, v in got.items()} == {k: plain_scan(v.tolist(), 3) for k, v in files.items() if len(v)}


def test_query_matches_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op1_token_counts(spark, SF_ORACLE).collect()}
    want = [len(e.ids) for e in library.encode_batch([t or "" for _, t in docs], add_special_tokens=False)]
    assert len(got) == len(docs)
    assert [(got[i].n_tokens, got[i].ended) for i, _ in docs] == [(n, True) for n in want]


def test_edge_rows(spark):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "a b<|endoftext|>c", "z"), (3, "word " * 200000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, file string")
    got = sorted((r["id"] or 0, r.n_tokens) for r in token_counts(df, PATH).collect())
    assert got[1:] == [(1, 0), (1, 0), (2, 0), (3, 200001)] and got[0][1] > 5
    assert token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
