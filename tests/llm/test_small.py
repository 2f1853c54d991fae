"""Personal data, quality rules, urls, chat and components on small cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from veil.llm import chat, pii, quality_rules as Q, url_filter as U
from veil.llm.graph import components
from veil.llm.queries import RULES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    v = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))]
    return sum(v) % 10 == 0


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), n, m.end(), f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_pii_base(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    odd = [
        "a@b.c_d@e.f x", "x@y@z.com", "1.2.3.4.5.6.7.8", "0001.002.3.4 256.1.1.1 ٣.1.1.1.1", "+1 (743) 555-3824 +1 ((( 2", "4111 1111-1111 1111 4111111111111112",
        "é" * 7 + " mail: q.w@mail5.example.com, card 5500000000000004", "9" * 30_000, "a" * 30_000 + " @ ", "", None, "call (743) 555-3824 or bob (at) mail (dot) com",
    ]
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(10_000_000 + i, t) for i, t in enumerate(odd)]
    got = pii.pii_by_document(spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, row string"))
    got = {r.doc_id: r for r in got.collect()}
    assert len(got) == len(rows)
    for d, t in rows:
        want = base_spans(t or "")
        assert got[d].base_sha256 == hashlib.sha256(",".join(w[3] for w in want).encode()).hexdigest(), (d, t[:80], got[d].spans)
        assert [got[d][f"n_{k}"] for k in BASE] == [sum(w[1] == n for w in want) for n in range(4)]
        assert {w[3] for w in want} <= set(got[d].spans.split(","))
    assert pii.pii_by_document(docs.limit(0)).count() == 0


def test_reliability_learns_from_agreement():
    counts = {(1, 1, 1): 300, (1, 1, 0): 200, (-1, -1, 0): 400, (-1, -1, -1): 100, (-1, 1, 0): 50, (0, 1, 1): 20}
    model = pii.estimate(counts)
    assert model.posterior((1, 1, 0)) > 0.9 > 0.1 > model.posterior((-1, -1, 0))
    assert model.posterior((0, 1, 1)) > 0.5 and pii.estimate({}).prior == 0.5


def test_quality_edges(spark):
    clean = "\n".join(" ".join(f"word{i}x{j}" for j in range(9)) + "." for i in range(12))
    rows = [(1, clean), (2, None), (3, ""), (4, " \n "), (5, ("same three words " * 40).strip()), (6, "\n".join(" | ".join(f"w{i}x{j}" for j in range(5)) for i in range(20)))]
    frame = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id bigint, text string, kept int")
    got = {r.doc_id: r for r in Q.apply_quality_rules(frame).collect()}
    assert [got[d].kept for d in range(1, 7)] == [True, False, False, False, False, False]
    assert got[5].n_repeat_words == 120 and not got[6].base_failed and got[6].n_lines_removed == 20 and got[2].n_words == 0
    assert Q.apply_quality_rules(frame.limit(0)).count() == 0


def test_urls(spark):
    rows = [
        (1, "https://A.Example.ORG/es/x?y", ""), (2, "http://x.org/a#b", None), (3, "http://shop.com/de/1", ""), (4, None, ""), (5, "no scheme", ""),
        (6, "http://example.org", ""), (7, "http://good.net/a", '<a href="http://shop.com/en/">'), (8, "http://fan.net/", '<a href="//shop.com/x">' * 3), (9, "u://a?b://c", ""),
    ]
    got = {r.page_id: r for r in U.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string, html string"), RULES).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2].rule == "org/" and got[2].path == "/a" and got[3].verdict == "block"
    assert [(got[i].host, got[i].path, got[i].verdict) for i in (4, 5)] == [("", "", "allow")] * 2
    assert got[6].rule is None and (got[9].host, got[9].path) == ("a", "")
    assert got[8].verdict == "block" and got[8].distrust > 0
    assert U.filter_urls(spark.createDataFrame([], "page_id bigint, url string, html string"), RULES).count() == 0


def test_chat_edges(spark):
    rows = [
        (1, 0, "user", "hi \\ <s> [/INST] </s>"), (1, 1, "assistant", "<ans> ok </s>"), (2, 0, "assistant", None), (2, 1, "odd]role", "[ROLE=x] y"), (3, 5, None, ""),
        (None, 0, "user", "a"), (4, 1, "user", "same"), (4, 1, "user", "same"),
    ]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, seq int")
    segments = chat.format_chat(frame)
    text = {}
    for r in sorted(segments.collect(), key=lambda r: (repr(r.conv_id), r.seq)):
        text.setdefault(r.conv_id, []).append(r.segment)
    reader = chat.Reader(chat.DEFAULT)
    for conv, parts in text.items():
        assert reader.turns("".join(parts)) == [(r[2] or "", r[3] or "") for r in rows if r[0] == conv]
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    assert {c: r.n_violations for c, r in got.items()} == {1: 0, 2: 3, 3: 2, None: 1, 4: 2}
    assert chat.read_back(chat.format_chat(frame.limit(0))).count() == 0
    with pytest.raises(ValueError):
        chat.Template({"user": chat.Part("<x><", "<y>")}, chat.Part("[{role}]", "[x]"), {}, ())


def test_components(spark):
    import random

    random.seed(3)
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 300)] + [(400, 401), (401, 400), (5, 5), (None, 7)]
    random.shuffle(links)
    frame = spark.createDataFrame(links, "id1 bigint, id2 bigint")
    got = {r.id: r.component for r in components(frame).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 300)}, 400: 400, 401: 400}
    assert components(frame.limit(0)).count() == 0


def test_mix_carries_columns_of_any_name(spark):
    from veil.llm import mix

    rows = [(i, "ab"[i % 2] if i else None, f"w {'x ' * (i % 5)}", i, i, i, i, "t") for i in range(40)] + [(3, "b", "w " * 300_000, 0, 0, 0, 0, "t")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, key int, piece int, offset int, rows int, target string")
    out = mix.mix_sources(docs, mix.word_count(F.col("text")), carry=["key", "piece", "offset", "rows", "target", "text"]).collect()
    assert len(out) == 41 and all(r.key == r.piece == r.offset == r.rows for r in out)
    assert {(r.doc_id, r.taken) for r in out} == {(r.doc_id, r.taken) for r in mix.mix_sources(docs, mix.word_count(F.col("text"))).collect()}
