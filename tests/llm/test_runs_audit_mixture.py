"""Periodic runs, filter audit and mixing against brute force, on edge cases and on the smallest tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from caudal.llm import audit, mixture, runs
from caudal.llm.common import ship_package, table
from caudal.llm.queries import QUERIES, SQL
from compare import difference

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def llm(spark):
    ship_package(spark)
    return spark


def brute_runs(words, least=24, times=3):
    """Every maximal stretch by the plain definition: all lags, then the smallest period of each stretch."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, times * q):
                found.setdefault((start, length), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def digest(words):
    found = brute_runs(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    top = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(collapsed(words, found))


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_of_small_alphabets():
    random.seed(9)
    for least, times in ((24, 3), (6, 3), (1, 4), (50, 3)):
        texts = [random.choices("ab" if k % 2 else "abc", k=random.choice((0, 1, 5, 40, 90))) for k in range(60)]
        for k in range(60):  # runs beside and inside one another
            block = random.choices("abcd", k=random.randint(1, 20))
            nested = block * random.randint(1, 6) + random.choices("abcd", k=random.randint(0, 4))
            texts.append(random.choices("abcd", k=7) + nested * random.randint(1, 4) + block[: random.randint(0, len(block))])
        texts += [["a"] * 700, list("ab") * 300, (["a"] * 40 + ["b"]) * 9, list("abaab" * 3 + "c") * 8]
        number = {x: i for i, x in enumerate("abcd")}
        bounds = np.cumsum([0] + [len(x) for x in texts])
        rows = runs.periodic_runs(np.array([number[w] for x in texts for w in x], dtype=np.int64), bounds, least, times)
        got = collections.defaultdict(list)
        for text, *run in rows.tolist():
            got[text].append(tuple(run))
        assert [got[i] for i in range(len(texts))] == [brute_runs(x, least, times) for x in texts]


def test_a_hot_word_and_long_texts_stay_cheap():
    words = np.zeros(400_000, dtype=np.int64)
    assert runs.periodic_runs(words, np.array([0, len(words)]), 24, 3).tolist() == [[0, 0, len(words), 1]]
    for text in (["a"] * 24, list("abc") * 8, list("abcdefgh") * 3, ["a"] * 23):
        ids = np.array([ord(x) for x in text], dtype=np.int64)
        assert [tuple(r[1:]) for r in runs.periodic_runs(ids, np.array([0, len(ids)]), 24, 3).tolist()] == brute_runs(text)
    block = np.arange(1000)
    words = np.r_[np.tile(block, 50), 5000, np.tile(block[:7], 10)]
    assert runs.periodic_runs(words, np.array([0, len(words)]), 24, 3).tolist() == [[0, 0, 50_000, 1000], [0, 50_001, 70, 7]]


def test_runs_edges(llm):
    random.seed(3)
    text = lambda n: " ".join(random.choice(("ä", "b", "c d", "D")) for _ in range(n))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x " * 23), (5, "x\v" * 24), (None, "y " * 30), (None, "y " * 30), (6, text(3000)), (7, "a b c " * 9 + "a\nb"), (7, "a b c " * 9 + "a\nb")]
    docs = llm.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, runs int, collapsed string").repartition(3)
    found = runs.find_runs(docs)
    got = collections.Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in found.collect())
    wanted = collections.Counter()
    for d, t in rows:
        words = WORD.findall(t or "")
        wanted[d, len(words), tuple(brute_runs(words)), collapsed(words, brute_runs(words))] += 1
    assert got == wanted
    digests = collections.Counter(tuple(r) for r in runs.digest_columns(found).collect())
    assert digests == collections.Counter((d, *digest(WORD.findall(t or ""))) for d, t in rows)
    assert runs.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.find_runs(docs, 24, 2)


def test_runs_of_the_documents(llm, sf):
    docs = [(r.doc_id, r.text) for r in table(llm, sf, "documents").collect()]
    found = {tuple(r) for r in QUERIES["op11_periodic_runs"](llm, sf).collect()}
    assert found == {(d, *digest(planted(d, t))) for d, t in docs}
    assert sum(1 for r in found if r[1]) > 5


def write(frame, folder, name):
    frame.repartition(3).write.parquet(str(folder / f"{name}.parquet"))


def sql_over(folder, *names):
    import duckdb

    con = duckdb.connect()
    for name in names:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return con


def long_texts():
    random.seed(6)
    word = lambda: random.choice(("Ka", "lo", "mÏ", "ne", "$u", "TÉ")) + random.choice("abcdefghij")
    return ["  ".join(word() for _ in range(random.choice((3, 150, 199, 200, 201, 400)))) for _ in range(40)] + ["", " \n", "A" * 500, "a b " * 120, "#"]


def test_filter_audit_edges(llm, tmp_path):
    texts = long_texts()
    rows = [(i, random.choice((*texts, None)), random.choice(("en", "de", "", None))) for i in range(300)]
    rows += [(1000 + i, texts[0], "en") for i in range(500)] + [(None, texts[0], "fr"), (None, texts[0], "fr"), (None, "", None), (7, texts[0], "xx"), (7, texts[0], "xx"), (-3, texts[1], "en")]
    docs = llm.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lang string, part int, n int")
    labels = [(i, random.choice((0, 1, None)), random.choice((0, 1, None))) for i in range(-5, 1200, 2)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (0, 1, 1)]
    write(docs, tmp_path, "documents")
    write(llm.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    con = sql_over(tmp_path, "documents", "labels")
    message, found, _ = difference(con, llm, str(tmp_path), QUERIES["op12_filter_audit"], SQL["op12_filter_audit"])
    assert message is None and found == 5 * 600
    none = audit.audit(docs.limit(0), table(llm, str(tmp_path), "labels"))
    assert none.count() == 0 and none.columns[0] == "part"


def test_survival_words_by_brute_force(llm):
    random.seed(2)
    masks = [(random.choice("pq"), random.choice((True, False)), random.choice((True, False)), random.randrange(32), random.choice((1, 2, 7, 100_000))) for _ in range(500)]
    marked = llm.createDataFrame(masks, "part string, good boolean, toxic boolean, failed int, n long").repartition(4)
    left = {(r.part, r.subset): (r.documents, r.good, r.toxic) for r in audit.survivors(marked).collect()}
    for part, subset in itertools.product("pq", range(32)):
        own = [m for m in masks if m[0] == part and not m[3] & subset]
        assert left[part, subset] == (sum(m[4] for m in own), sum(m[4] for m in own if m[1]), sum(m[4] for m in own if m[2]))
    words = np.array([random.randrange(2**32) for _ in range(1001)], dtype=np.uint32)
    weights = np.array([random.randrange(1000) for _ in words], dtype=np.int64)
    assert audit.positional_counts(words, weights).tolist() == [sum(int(w) for x, w in zip(words.tolist(), weights, strict=True) if x >> b & 1) for b in range(32)]


def test_hot_copies_reach_the_comparison_folded(llm):
    docs = llm.range(5000).selectExpr("id AS doc_id", "'same text' AS text", "'en' AS lang").repartition(4)
    labels = llm.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    found = {(r.failed, r.good): r.n for r in audit.judged(docs, labels).collect()}
    assert found == {(1, True): 1, (17, False): 4999}


def brute_targets(sizes, weights=(1, 2, 3), total=None, most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = float(sum(sizes.values()) if total is None else total), set(order), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def mixture_rows():
    random.seed(12)
    size = lambda: random.choice((0, 1, 2, 30, 200))
    rows = [(i, "w " * size(), "big") for i in range(900)] + [(2000 + i, "x\n" * size(), random.choice(("a", "b", "ß", "Z", "~", "", None))) for i in range(200)]
    rows += [(3000, "rare words here", "tiny"), (None, "one two", "big"), (None, "one two", "big"), (None, None, "empty"), (5, None, None), (4000, "é" * 5000 + " b", "long")]
    return rows + [(77, "same row again", "big")] * 300 + [(78, "", "big")] * 20


def frame(llm, rows):
    return llm.createDataFrame([(*r, 1, 2.0, 3) for r in rows], "doc_id long, text string, source string, size int, target double, key int").repartition(5)


def test_mixture_edges(llm):
    rows = mixture_rows()
    found = mixture.mix(frame(llm, rows), range_rows=50, copies=64).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert collections.Counter((r.doc_id, r.source, r.size) for r in found) == collections.Counter((d, s, size(t)) for d, t, s in rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    target, taken = brute_targets(sizes), collections.Counter()
    cut = collections.Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        cut[r.source] += bool(r.size and r.taken % r.size)
    assert all(taken[s] == int(target[s] + 1e-9) for s in sizes) and max(cut.values()) == 1
    again = mixture.mix(frame(llm, rows[::-1]).repartition(2), range_rows=50, copies=64).collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter(map(tuple, again))
    # The order is random: what is taken does not follow the ids.
    gone = [r.doc_id for r in found if r.source == "big" and r.size and not r.taken and r.doc_id]
    assert gone and min(gone) < 200 and max(gone) > 700
    other = mixture.mix(frame(llm, rows), seed="other", range_rows=50).collect()
    assert collections.Counter(map(tuple, found)) != collections.Counter(map(tuple, other))
    assert mixture.mix(frame(llm, rows).limit(0)).count() == 0


def test_mixture_epochs_and_budgets(llm):
    docs = frame(llm, [(i, "a b c", "s") for i in range(10)] + [(20 + i, "d e", "t") for i in range(10)])
    plan = mixture.mix(docs, weights=(1, 1), total=77, most=3)
    assert {(r.source, r.target) for r in plan.collect()} == {("s", 38.5), ("t", 38.5)}
    texts = collections.defaultdict(list)
    for r in mixture.mixed_texts(docs, plan).collect():
        texts[r.source].append((r.doc_id, r.epoch, r.text))
    assert sum(len(t.split()) for _, _, t in texts["s"]) == 38 == sum(len(t.split()) for _, _, t in texts["t"])
    assert sorted(d for d, e, _ in texts["s"] if e == 1) == list(range(10)) and {e for _, e, _ in texts["s"]} == {1, 2}
    assert all(t in ("a b c", "a b", "a") for _, _, t in texts["s"])
    full = mixture.mix(docs, total=10_000)
    assert {(r.taken, r.size) for r in full.collect()} == {(9, 3), (6, 2)}


def test_mixture_matches_sql_with_repeated_rows(llm, tmp_path):
    rows = [r for r in mixture_rows() if r[1] is None or len(r[1]) < 400]
    write(frame(llm, rows), tmp_path, "documents")
    message, found, _ = difference(sql_over(tmp_path, "documents"), llm, str(tmp_path), QUERIES["op13_mix_sources"], SQL["op13_mix_sources"])
    assert message is None and found == len(rows)


def test_mixture_runs_no_python(llm, sf):
    plan = QUERIES["op13_mix_sources"](llm, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
