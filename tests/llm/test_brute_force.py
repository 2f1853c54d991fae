"""Decontamination, language model and pipeline stages against brute force on small fixtures."""

import math
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline as P
import pytest
from veil.llm import decontaminate as D
from veil.llm import langid, line_dedup, ngram_join

WORD = re.compile("[^\x20\x09-\x0D]+")


def plain_words(text):
    return WORD.findall(re.sub(r"[^\w\x20\x09-\x0D]|_", "", (text or "").lower()))


def bag(words, k=5):
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else Counter([tuple(words)] if words else [])


def contaminated(docs, items, similarity=0.8):
    """(doc, item): some window as long as the item is similar enough; every window of every document is tried."""
    bags = {i: bag(plain_words(t)) for i, t in items}
    held = Counter(s for b in bags.values() for s in b)
    weight = lambda s: 1 / (1 + math.log2(max(1, held[s])))
    found = {}
    for d, text in docs:
        words = plain_words(text)
        for i, t in items:
            n = len(plain_words(t))
            if not n or not words:
                continue
            best = 0
            for start in range(max(1, len(words) - n + 1)):
                w = bag(words[start:start + n])
                both, either = w & bags[i], w | bags[i]
                top, total = sum(weight(s) * c for s, c in both.items()), sum(weight(s) * c for s, c in either.items())
                best = max(best, top / total if total else 0)
            if best >= similarity - 1e-9:
                found[d, i] = best
    return found


def altered(words, chance, changes):
    words = list(words)
    for _ in range(changes):
        at, how = chance.randrange(len(words)), chance.choice("sid")
        if how == "s":
            words[at] = f"new{chance.randrange(1000)}"
        elif how == "i":
            words.insert(at, f"more{chance.randrange(1000)}")
        elif len(words) > 8:
            del words[at]
    return words


def test_altered_passages_against_every_window(spark):
    """Passages with substituted, inserted and deleted words; every pair within the threshold is found, and no other."""
    chance = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(chance.choice(vocabulary) for _ in range(chance.choice([8, 40, 60, 90])))) for i in range(12)]
    items += [(20, items[0][1]), (21, ""), (22, None), (23, "two words"), (None, items[1][1])]
    docs = []
    for d in range(150):
        around = [chance.choice(vocabulary) for _ in range(chance.randrange(0, 80))]
        passage = altered(items[chance.randrange(12)][1].split(), chance, chance.choice([0, 1, 1, 2, 3, 5]))
        text = " ".join(around + passage + around[::-1])
        docs.append((d, text.upper() if d % 7 == 0 else text.replace(" ", ", ") if d % 7 == 1 else text))
    docs += [(200, None), (201, ""), (202, "two words"), (203, " ".join(vocabulary * 30) + " " + items[2][1] + " " + " ".join(vocabulary * 30))]
    real = [(i, t) for i, t in items if i is not None]
    want = contaminated(docs, real)
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id bigint, text string, shingle string, start int")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, n_words int")
    got = {(r.doc_id, r.item_id): r.similarity for r in D.decontaminate(frame, bench).collect()}
    assert set(got) - set(want) == set()
    recall = len(set(got) & set(want)) / len(want)
    assert recall == 1.0, sorted(set(want) - set(got))[:5]
    for pair, best in got.items():
        assert best == pytest.approx(want[pair])
    assert (203, 2) in got


def test_decontamination_edges(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "one two three four five six seven eight"), (1, "clean words"), (2, "clean words here"), (None, "one two three four five six seven eight")], "doc_id bigint, text string")
    assert sorted((r.doc_id is None, r.doc_id) for r in D.keep_clean(docs, bench).collect()) == [(False, 2), (True, None)]
    assert D.keep_clean(docs, bench.limit(0)).count() == 4
    assert D.keep_clean(docs.limit(0), bench).count() == 0
    assert D.contaminated(docs, bench).count() == 4


def test_language_model_against_plain_counts(spark):
    """Log-probabilities and posteriors from counts made text by text, without Spark or slices."""
    texts = {"en": ["the cat and the dog", "this is the house of the man"], "de": ["der hund und die katze", "das ist das haus des mannes"], "fr": ["le chat et le chien", "la maison de la rue"]}
    rows = [(i, t, lang, "x") for i, (lang, t) in enumerate((lang, t) for lang, ts in texts.items() for t in ts)]
    rows += [(100, None, "en", "x"), (101, "no language", None, "x"), (0, rows[0][1], rows[0][2], "x")]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    model = langid.train(labelled)
    assert model.languages == ["de", "en", "fr"]

    def buckets(text):
        out = Counter()
        for points, of in langid._pieces([text]):
            for bucket, _ in langid.ngrams(points, of):
                out.update(bucket.tolist())
        return out

    size = model.log_probability.shape[0]
    counts = defaultdict(Counter)
    for _, t, lang, _ in rows:
        if t and lang:
            counts[lang] += buckets(t)
    log = {lang: {b: math.log((counts[lang][b] + 1) / (sum(counts[lang].values()) + size)) for b in range(size)} for lang in model.languages}
    tests = ["the house", "das haus", "la maison et le chat", "katze", "", "123 456", None, "the " * 3000]
    got = langid.identify(spark.createDataFrame([(i, t) for i, t in enumerate(tests)], "doc_id bigint, text string"), model).collect()
    for r in got:
        if not r.text or not re.search(r"[^\W\d_]", r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        sums = {lang: sum(n * log[lang][b] for b, n in buckets(r.text).items()) for lang in model.languages}
        best = max(sums, key=sums.get)
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 / sum(math.exp(s - sums[best]) for s in sums.values()), abs=1e-3)


# --- the pipeline's stages -----------------------------------------------------

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def stage(spark, sf_dir, name, rows):
    out = dict(P.STAGES)[name](spark, spark.createDataFrame(rows, DOCS), sf_dir)
    if name != "mix_sources":
        assert out.columns == P.COLUMNS
    return out.collect()


ODD = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "some words of no id", "en", "a", 19), (3, "some words", None, None, 10), (3, "some words", None, None, 10), (4, "x" * 300_000, "en", "b", 300_000), (5, " \n ", "de", "a", 3)]


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_take_any_rows(spark, sf_dir, name):
    assert stage(spark, sf_dir, name, []) == []
    got = stage(spark, sf_dir, name, ODD)
    ids = Counter(r.doc_id for r in got)
    if name == "line_dedup":
        assert ids == {1: 1, 2: 1, None: 1, 3: 1, 4: 1, 5: 1} or ids == {1: 1, 2: 1, None: 1, 3: 2, 4: 1, 5: 1}
    if name in ("ngram_jaccard_join", "decontamination"):
        assert ids == {1: 1, 2: 1, None: 1, 3: 2, 4: 1, 5: 1}
    if name == "language_id":
        assert 1 not in ids and 2 not in ids and 5 not in ids


def test_near_copies_leave_the_pipeline(spark, sf_dir):
    """Of each group of near copies (five words, 0.8) one document is left after line dedup and the join; other documents stay."""
    chance = random.Random(3)
    rows, group = [], {}
    for g in range(30):
        base = [[f"g{g}l{i}w{chance.randrange(500)}" for _ in range(14)] for i in range(12)]
        for copy in range(1 + 2 * (g % 2)):
            lines = [list(x) for x in base]
            for _ in range(copy):
                at = chance.randrange(12)
                lines[at][chance.randrange(14)] = f"changed{chance.randrange(10_000)}"
            d = 100 * copy + g
            group[d] = g
            rows.append((d, "\n".join(" ".join(x) for x in lines), "en", "a", 1))
    for g in range(30, 60):  # a shared notice of a few lines makes no near copy
        own = "\n".join(" ".join(f"g{g}l{i}w{chance.randrange(500)}" for _ in range(12)) for i in range(10))
        rows.append((g, own + "\nthis notice is the same in all of these documents and has many words in it", "en", "a", 1))
        group[g] = g
    docs = spark.createDataFrame(rows, DOCS)
    kept = P.dedup_documents(spark, P.dedup_lines(spark, docs, sf_dir), sf_dir).select("doc_id").collect()
    assert Counter(group[r.doc_id] for r in kept) == Counter(range(60))


def test_mixing_stage_against_plain_sums(spark, sf_dir):
    rows = [(i, "w " * (i % 9), "en", "abc"[i % 3] if i % 4 else None, 1) for i in range(200)]
    got = stage(spark, sf_dir, "mix_sources", rows)
    taken = defaultdict(int)
    for r in got:
        assert 0 < r.taken <= 2 * r.size and r.size == len(WORD.findall(r.text))
        taken[r.source] += r.taken
    targets = {r.source: r.target for r in got}
    for source, target in targets.items():
        assert taken[source] == math.floor(target)
    whole = sum(len(WORD.findall(t)) for _, t, *_ in rows)
    assert sum(targets.values()) == pytest.approx(1.5 * whole)


def test_a_document_of_near_copied_lines(spark):
    """20,000 lines of one document that differ in their last word: the first one stays."""
    base = " ".join(f"w{i}" for i in range(30))
    lines = [f"{base} x{i}" for i in range(20_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines), 5)], "doc_id bigint, text string, n_lines int")
    (row,) = line_dedup.dedup_lines(docs).collect()
    assert (row.n_lines, row.n_removed, row.text) == (20_000, 19_999, lines[0])
    assert ngram_join.ngram_jaccard_join(docs).count() == 1


def test_sketch_counts_every_bucket_over_all_tasks(spark):
    import numpy as np

    from veil.llm import setjoin

    docs = spark.range(0, 40, 1, 5).selectExpr("repeat('x', cast(id % 7 as int)) text")
    hashes = lambda column: (np.array([len(v) * 512 + 3] * 2, np.uint64) for v in column.to_pylist())
    weight = setjoin.corpus_weights(docs, "text", hashes, 13).value
    expected = np.zeros(1 << 13, np.uint8)
    for i in range(7):
        expected[i * 512 + 3] = int(4 * np.log2(2 * len(range(i, 40, 7))))
    assert weight.tolist() == expected.tolist()
