"""Quality rules against brute force, and the defined edge cases."""

import re
from collections import Counter

from conftest import SF_ORACLE
from vaultlens.llm.quality import clean_documents, line_rules, op3_quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text or "")
    lines = [l for l in (text or "").split("\n") if WORD.search(l)]
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(wins)
    hit = {i + k for i, w in enumerate(wins) if seen[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit), failed)


def norm(line):
    return re.sub("[0-9]+", "0", re.sub(r"[\x20\x09-\x0D]+", " ", line)).strip(" ").lower()


def brute_rules(rows, min_docs=10, max_share=0.05):
    """rows: (id, host, text) -> list of (id, kept, n_removed_lines, n_kept_words)"""
    texts = {(h, t or "") for _, h, t in rows}
    host_docs = Counter(h for h, _ in texts)
    n_docs = Counter((h, l) for h, t in texts for l in {norm(x) for x in t.split("\n") if WORD.search(x)})
    often = {k for k, n in n_docs.items() if n >= min_docs and n > max_share * host_docs[k[0]]}
    out = []
    for i, h, t in rows:
        base = brute_base(t)
        gone = [l for l in (t or "").split("\n") if WORD.search(l) and (h, norm(l)) in often]
        left = base[0] - sum(len(WORD.findall(l)) for l in gone)
        out.append((i, not base[5] and left >= 0.3 * base[0], len(gone), left))
    return out


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "source", "text").collect()
    got = {r.doc_id: r for r in op3_quality_rules(spark, SF_ORACLE).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(d.text)
    want = brute_rules([(d.doc_id, d.source, d.text) for d in docs])
    assert sorted((r.doc_id, r.kept, r.n_removed_lines, r.n_kept_words) for r in got.values()) == sorted(want)


def rows():
    body = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    out = [(i, "h", f"Footer  {i} All Rights\n{body} x{chr(97 + i)} y{chr(97 + i)}") for i in range(12)]       # frequent line, kept
    out += [(100 + i, "h", f"footer 7 all rights\nfew words x{i}") for i in range(3)]           # under 10 words: base rule
    out += [(200 + i, "h", f"FOOTER 1 all rights\n" * 8 + f"tiny u{i} v{i}") for i in range(2)]
    out += [(300, None, None), (301, "h", ""), (302, "h", " \n\n\t"), (303, None, f"{body} ä€😀 #*"), (304, "o", "a b c d e " * 20000)]
    out += [(400, "h", f"Footer 9 all rights\n{body} same"), (400, "h", f"Footer 9 all rights\n{body} same")]
    return out


def test_rules_and_edge_cases(spark):
    df = spark.createDataFrame([(i, h, t, "x", 1) for i, h, t in rows()], "doc_id long, source string, text string, id string, n_words int")
    got = line_rules(df).collect()
    assert sorted((r["id"], r.kept, r.n_removed_lines, r.n_kept_words) for r in got) == sorted(brute_rules(rows()))
    by_id = {r["id"]: r for r in got}
    for i, _, t in rows():
        r = by_id[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(t)
    kept = clean_documents(df)
    assert kept.columns == df.columns
    texts = {(r.doc_id, r.text) for r in kept.collect()}
    assert (3, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu xd yd") in texts
    assert kept.where("doc_id = 400").count() == 2 and kept.where("doc_id in (300, 301, 302, 304)").count() == 0
    assert kept.where("doc_id = 303").count() == 1


def test_all_native(spark):
    plan = op3_quality_rules(spark, SF_ORACLE)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, source string, text string")
    assert line_rules(df).count() == 0 and clean_documents(df).count() == 0
