"""Trust over the host graph against plain PageRank, spans that the labelers and the classifier add, work tables."""

import random
import re
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from veil.llm import common, pii, quality_rules, url_filter
from veil.llm.queries import QUERIES, RULES
from veil.runtime import work_base


def plain_scores(pages, rules, rounds, damping=0.85):
    """(trust, distrust) by host, in plain Python."""
    def host(url):
        return re.split("[/?#]", url.split("://", 1)[1])[0].lower() if url and "://" in url else ""

    def path(url):
        return re.sub("^[^/]*", "", re.split("[?#]", url.split("://", 1)[1])[0]) if host(url) else ""

    edges, seeds = defaultdict(float), {"trust": defaultdict(int), "distrust": defaultdict(int)}
    hosts = {host(u) for _, u, _ in pages} - {""}
    for h in hosts:
        names = [h]
        while "." in names[-1]:
            names.append(names[-1].split(".", 1)[1])
        for a, b in zip(names, names[1:]):
            edges[a, b], edges[b, a] = max(edges[a, b], 1), max(edges[b, a], 1)
    for _, url, html in pages:
        for to in re.findall("(?i)href\\s*=\\s*[\"']?((?:https?:)?//[^\"'\\s>]+)", html or ""):
            dst = host("http:" + to if to.startswith("//") else to)
            if host(url) and dst and dst != host(url):
                edges[host(url), dst] += 1
        fits = [r for r in rules if host(url) and (host(url) == r.host or host(url).endswith("." + r.host)) and path(url).startswith(r.path)]
        if fits:
            best = max(fits, key=lambda r: len(r.name))
            seeds["trust" if best.verdict == "allow" else "distrust"][host(url)] += 1
    out = {}
    for kind, named in seeds.items():
        step = defaultdict(list)
        for (a, b), n in edges.items():
            step[a if kind == "trust" else b].append((b if kind == "trust" else a, n))
        total = sum(named.values())
        start = {h: n / total for h, n in named.items()}
        scores = dict(start)
        for _ in range(rounds):
            new = defaultdict(float, {h: (1 - damping) * s for h, s in start.items()})
            for h, s in scores.items():
                whole = sum(n for _, n in step[h])
                for to, n in step[h]:
                    new[to] += damping * s * n / whole
            scores = new
        out[kind] = scores
    return out


def test_scores_are_those_of_plain_pagerank(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = url_filter.filter_urls(pages, RULES).collect()
    want = plain_scores([(r.page_id, r.url, r.html) for r in pages.collect()], RULES, url_filter.ROUNDS)
    assert url_filter.host_edges(pages.select(url_filter.host_of(F.col("url")).alias("host"), "html")).count() > 0
    for r in got:
        assert r.trust == pytest.approx(want["trust"].get(r.host, 0), abs=1e-12)
        assert r.distrust == pytest.approx(want["distrust"].get(r.host, 0), abs=1e-12)
        if r.rule is None:
            assert r.verdict == ("block" if r.distrust > r.trust else "allow")


def test_verdicts_that_propagation_alone_decides(spark):
    rules = (url_filter.Rule("good.org", "/", "allow"), url_filter.Rule("bad.com", "/", "block"))
    link = lambda to: f"<a href='http://{to}/'>x</a>"
    pages = [
        (1, "http://good.org/", link("friend.net")), (2, "http://friend.net/a", None), (3, "http://bad.com/", ""), (4, "http://farm.net/x", link("bad.com") * 3),
        (5, "http://a.shop.bad.com/y", ""), (6, None, None), (7, "nothing", ""), (8, "http://alone.example/", ""), (8, "http://alone.example/", ""),
    ]
    frame = spark.createDataFrame([(*p, "c", 1, 2.0) for p in pages], "page_id bigint, url string, html string, chain string, n int, score double")
    verdict = lambda rounds: {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(frame, rules, rounds).collect()}
    after, before = verdict(10), verdict(0)
    assert after[4] == (None, "block") and before[4] == (None, "allow")
    assert after[2] == (None, "allow") and after[8] == (None, "allow") and after[6] == after[7] == (None, "allow")
    assert after[5] == ("bad.com/", "block")
    long = spark.createDataFrame([(1, "http://a.b.c/", "<p>" + "x" * 500_000 + link("d.e") + "//" * 100_000)], "page_id bigint, url string, html string")
    assert url_filter.filter_urls(long, rules).count() == 1


# --- spans the method adds ----------------------------------------------------

def planted(chance):
    """(text, spans that are personal, spans that look alike)."""
    digits = lambda n: "".join(chance.choice("0123456789") for _ in range(n))
    name = lambda: chance.choice(["ann", "bob.lee", "c_kim", "dora"]) + digits(2)

    def card(good):
        body = "4" + digits(14)
        check = next(c for c in "0123456789" if sum(sum(map(int, str(int(x) * (2 if i % 2 else 1)))) for i, x in enumerate(reversed(body + c))) % 10 == 0)
        number = body + (check if good else str((int(check) + 1 + chance.randrange(8)) % 10))
        return ".".join(number[i:i + 4] for i in range(0, 16, 4))

    group = lambda: "".join(chance.choice("0123456789abcdef") for _ in range(4))
    forms = {
        "email": (lambda: f"{name()} (at) mail{digits(1)} (dot) com", lambda: f"{name()} (at) mail{digits(1)} [dot] zzq"),
        "phone": (lambda: f"({chance.choice('23456')}{chance.choice('02345')}{chance.choice('0234567')}) {chance.choice('23456789')}{digits(2)}-{digits(4)}", lambda: f"{chance.choice('01')}{digits(2)}-{chance.choice('01')}{digits(2)}-{digits(4)}"),
        "card": (lambda: card(True), lambda: card(False)),
        "ip": (lambda: "2001:0db8:" + ":".join(group() for _ in range(5)) + ":a" + group()[:3], lambda: ":".join(digits(2) for _ in range(8))),
    }
    words = {"email": ("write to", "version"), "phone": ("call me at", "serial"), "card": ("my visa card", "invoice"), "ip": ("server address", "section")}
    for kind, makers in forms.items():
        for true in (True, False):
            for _ in range(40):
                before = words[kind][0 if true else 1] if chance.random() < 0.7 else "lorem ipsum"
                yield f"Some words, then {before} ", makers[0 if true else 1](), " and more words after it.", kind, true


def test_loose_spans_are_found(spark):
    cases = list(planted(random.Random(7)))
    rows = [(i, a + span + b, "x") for i, (a, span, b, _, _) in enumerate(cases)] + [(1000, None, "x"), (1001, "", "x"), (1002, "write bob (at) mail1 (dot) com", "x"), (1002, "write bob (at) mail1 (dot) com", "x")]
    out = pii.pii_by_document(spark.createDataFrame(rows, "doc_id bigint, text string, spans string")).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    added = {i for i, r in by_id.items() if r.n_added > 0 and i < 1000}
    true = {i for i, c in enumerate(cases) if c[4]}
    assert len(added & true) >= 0.9 * len(true) and len(added & true) >= 0.9 * len(added)
    for i in added & true:
        a, span, _, kind, _ = cases[i]
        assert f"{kind}:{len(a)}:{len(a) + len(span)}" in by_id[i].spans.split(",")
    assert by_id[1000].spans == by_id[1001].spans == "" and by_id[1002].n_spans == 1


def test_votes_are_cast_on_loose_forms(spark):
    cases = list(planted(random.Random(8)))
    frame = spark.createDataFrame([(i, a + s + b) for i, (a, s, b, _, _) in enumerate(cases)], "doc_id bigint, text string")
    voted = pii.votes(pii.candidates(frame)).where("loose").select("kind", *pii.LABELERS).collect()
    assert {r.kind for r in voted} == set(pii.KINDS)
    for name in pii.LABELERS:
        assert {r[name] for r in voted} >= {-1, 1}


# --- long lines, work tables ---------------------------------------------------

def test_lines_of_any_length(spark):
    menu = "home " * 200_000
    texts = [menu + ".", menu, "!" * 500_000, "word " * 50_000 + "\n" + "x" * 1_000_000, "a b\n" * 50_000, "»" * 300_000, None, "", "home about us skip to content"]
    frame = spark.createDataFrame([(i, t, "given", 1) for i, t in enumerate(texts)], "doc_id bigint, text string, _words string, kept int")
    got = {r.doc_id: r for r in quality_rules.apply_quality_rules(frame.repartition(9)).collect()}
    assert got[0].n_words == 200_001 and got[0].n_lines_removed == 0 and got[1].n_lines_removed == 1
    assert got[0].n_repeat_words == 200_000 and got[1].n_repeat_words == 200_000
    assert got[4].n_dup_lines == 49_999 and got[8].n_lines_removed == 1
    assert {r._words for r in got.values()} == {"given"}
    assert got[6].n_words == 0 and got[6].base_failed and not got[6].kept


@pytest.mark.parametrize("name", ["op2_decontamination", "op6_ngram_jaccard_join", "op7_pii", "op8_url_filter", "op10_line_dedup", "op11_conversation_repair", "op12_exact_top_k", "op13_prefix_trie"])
def test_work_tables_go(spark, sf_dir, name):
    folder = Path(work_base(spark).removeprefix("file:"))
    held = lambda: {p.name for p in folder.iterdir()} if folder.exists() else set()
    common.release(spark)
    before = held()
    result = QUERIES[name](spark, sf_dir)
    assert len(held() - before) <= 1  # what the result is read from
    assert result.count() > 0
    common.release(spark)
    assert held() == before


def test_work_tables_go_after_a_failure(spark, monkeypatch):
    folder = Path(work_base(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}

    def fail(*args):
        raise OSError("gone")

    monkeypatch.setattr(pii, "classify", fail)
    with pytest.raises(OSError):
        pii.find_pii(spark.createDataFrame([(1, "a@b.de")], "doc_id bigint, text string"))
    assert {p.name for p in folder.iterdir()} == before
