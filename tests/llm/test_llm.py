"""The operators against brute force, on edge cases and on the smallest tables."""

from __future__ import annotations

import collections
import datetime
import hashlib
import os
import random
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from caudal.llm import blocks, containment, language, lines, listjoin, packing, simhash, tokens, topk, windows
from caudal.llm.common import hex64, ship_package, table
from caudal.llm.components import components
from caudal.llm.queries import QUERIES, SQL, tokenizer
from compare import connect, difference

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def llm(spark):
    ship_package(spark)
    return spark


#: Columns with names of results and keys, to clash.
SCHEMA = "doc_id long, text string, lang string, score double, lines string, row_d long, lang_pred string, nth int, n_chars int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", 0.5, "x", 1, "y", 2, 3) for d, t in rows], SCHEMA).repartition(3)


def edge_rows():
    random.seed(4)
    words = [a + b for a in ("ka", "lo", "mi", "ne") for b in ("ra", "su", "té", "vo", "ß")]
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    long, shared = text(30_000), text(60)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One"), (5, "one"), (6, long), (7, long), (None, text(20)), (None, None)]
    rows += [(10 + i, f"{text(25)}\n Same Line \n{shared}\n{text(5)}") for i in range(12)]
    rows += [(40, "ab " * 300), (41, "ab " * 300), (42, text(40)), (42, text(40)), (43, "x\n" * 40), (44, shared)]
    return rows + [rows[-1], rows[-2]]


def test_repeated_windows(llm):
    rows = edge_rows()
    found = windows.digest_columns(windows.cut_repeats(frame(llm, rows), 100)).collect()
    assert len(found) == len(rows)
    # One document per id and text; NULL first; rows of one id by the hash of their text.
    order = sorted({(-(2**63) if d is None else d, t or "") for d, t in rows}, key=lambda x: (x[0], np.uint64(xxhash.xxh64_intdigest(x[1].encode(), 42)).astype(np.int64)))
    seen, wanted = set(), {}
    for d, t in order:
        data = t.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(data[i : i + 100])
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        wanted[d, t] = (len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    expected = collections.Counter((d, *wanted[-(2**63) if d is None else d, t or ""]) for d, t in rows)
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == expected


def brute_components(prints, radius):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def brute_print(text, shingle=3):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def test_simhash_matches_brute_force(llm, sf):
    docs = table(llm, sf, "documents")
    found = QUERIES["op7_covering_simhash"](llm, sf).collect()
    prints = {r.doc_id: brute_print(r.text) for r in docs.collect()}
    roots = brute_components(prints, 3)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {(d, f"{p:016x}", roots[d]) for d, p in prints.items()}


def test_simhash_edges(llm):
    rows = edge_rows()
    found = simhash.near_duplicates(frame(llm, rows), 3, 3)
    found = found.select("doc_id", hex64(found["fingerprint"]).alias("p"), "component_id", "root").collect()
    assert collections.Counter((r.doc_id, r.p) for r in found) == collections.Counter((d, f"{brute_print(t):016x}") for d, t in rows)
    assert {r.component_id for r in found if r.p == "0" * 16} == {1}
    kept = simhash.keep_one(frame(llm, rows), 3, 3)
    assert kept.columns == frame(llm, rows).columns
    assert kept.count() == len({r.root for r in found})
    assert simhash.near_duplicates(frame(llm, []), 3, 3).count() == 0


def test_unrelated_documents_without_an_id_of_their_own_stay(llm):
    random.seed(11)
    text = lambda: " ".join(f"w{random.randrange(10**6)}" for _ in range(40))
    copied = text()
    rows = [(None, text()), (None, text()), (None, copied), (None, copied), (7, text()), (7, text()), (8, copied), (9, "Only one")]
    left = corpus_pipeline.near_duplicate_stage(llm, frame(llm, rows), "").collect()
    wanted = [r for r in rows if r[1] != copied] + [(8, copied)]
    assert collections.Counter((r.doc_id, r.text) for r in left) == collections.Counter(wanted)


def test_links_of_a_large_bucket(llm, monkeypatch):
    random.seed(9)
    centre = random.getrandbits(64)
    prints = {centre}
    for _ in range(400):
        x = random.choice(sorted(prints))
        prints.add(x ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)))
    prints |= {random.getrandbits(64) for _ in range(200)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    monkeypatch.setattr(simhash, "BLOCK", 16)
    found = components(simhash.links(llm.createDataFrame(signed, "fingerprint long"), 3)).collect()
    got = {r.node: r.root for r in found}
    groups = collections.defaultdict(set)
    for x, r in brute_components({x: x for x in prints}, 3).items():
        groups[r].add(x)
    wanted = {frozenset(g) for g in groups.values() if len(g) > 1}
    back = collections.defaultdict(set)
    for n, r in got.items():
        back[r].add(n % (1 << 64))
    assert {frozenset(g) for g in back.values()} == wanted


def test_masks_cover_every_small_difference():
    cover = simhash.masks(3)
    assert len(cover) == 15
    random.seed(1)
    for _ in range(3000):
        bits = sum(1 << b for b in random.sample(range(64), random.randint(0, 3)))
        assert any(not bits & m for m in cover)


def test_components_of_a_long_path(llm):
    edges = llm.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    found = {r.node: r.root for r in components(edges).collect()}
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def brute_lines(rows, min_docs, min_chars):
    key = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").lower()
    held = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            held[key(line)].add((d, t or ""))
    out = collections.Counter()
    for d, t in rows:
        all_lines = (t or "").split("\n")
        left = [x for x in all_lines if len(key(x).decode()) < min_chars or len(held[key(x)]) < min_docs]
        out[d, len(all_lines), len(all_lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("min_docs, min_chars", [(10, 1), (2, 1), (2, 12)])
def test_lines(llm, min_docs, min_chars):
    rows = edge_rows()
    found = lines.digest_columns(lines.dedup_lines(frame(llm, rows), min_docs, min_chars)).collect()
    assert collections.Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found) == brute_lines(rows, min_docs, min_chars)


def test_first_line_stays(llm):
    rows = [(3, "a\nkeep\nkeep"), (2, "keep\nb\nKEEP "), (9, "c\nkeep")]
    found = lines.dedup_lines(frame(llm, rows), 2, 1, keep="first")
    assert {r.doc_id: r.text for r in found.collect()} == {2: "keep\nb", 3: "a", 9: "c"}
    whole = lines.replace_texts(frame(llm, [*rows, (None, None)]), 2, 1)
    assert {(r.doc_id, r.text, r.n_chars) for r in whole.collect()} == {(2, "b", 1), (3, "a", 1), (9, "c", 1), (None, "", 0)}
    assert whole.columns == frame(llm, rows).columns
    assert lines.replace_texts(frame(llm, []), 2, 1).count() == 0


def test_packing_and_counts(llm):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer())
    rows = [*edge_rows(), (90, "a\t b  c\r\n d <|endoftext|> it's 3.14, no...  \n\n end "), (91, "é́. x  y\x1c z" * 50)]
    ids = lambda t: [*model.encode(t or "", add_special_tokens=False).ids, 0]
    found = packing.pack(frame(llm, rows), tokenizer(), 64, with_ids=True).collect()
    by_doc = collections.defaultdict(list)
    for r in found:
        assert r.length & (r.length - 1) == 0 and r.length <= 64 and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
        by_doc[r.doc_id].append(r)
    assert sorted(r.sequence_id for r in found) == list(range(len(found)))
    # A bucket of equal lengths is a range of numbers, the longest first.
    assert [r.length for r in sorted(found, key=lambda r: r.sequence_id)] == sorted((r.length for r in found), reverse=True)
    counts = collections.Counter(d for d, _ in rows)
    for d, t in rows:
        if counts[d] == 1:
            pieces = sorted(by_doc[d], key=lambda r: r.start)
            assert [x for r in pieces for x in r.ids] == ids(t) and [r.start for r in pieces] == list(np.cumsum([0, *(r.length for r in pieces)])[:-1])
    for path, count in ((tokenizer(), lambda t: len(ids(t)) - 1),):
        got = tokens.count_tokens(frame(llm, rows), path, 512).collect()
        wanted = collections.Counter((d, len((t or "").encode()), count(t), count(t) > 512) for d, t in rows)
        assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == wanted
    assert packing.pack(frame(llm, []), tokenizer()).count() == tokens.count_tokens(frame(llm, []), tokenizer()).count() == 0


def test_buckets_by_length(llm, tmp_path):
    packed = packing.pack(frame(llm, edge_rows()), tokenizer(), 64, with_ids=True)
    packing.write_buckets(packed, str(tmp_path / "b"))
    back = llm.read.parquet(str(tmp_path / "b"))
    assert back.count() == packed.count() and back.where("size(ids) <> length").count() == 0


def test_safe_pieces_keep_tokens():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer())
    random.seed(2)
    signs = list("ab Z9.,'!_-\n\t\r\x1c\x85 éß́中٣½") + ["<|endoftext|>", "'s", "  ", "\n\n"]
    for _ in range(4000):
        text = "".join(random.choice(signs) for _ in range(12))
        pieces = tokens.safe_pieces(text)
        assert "".join(pieces) == text
        assert [i for p in pieces for i in model.encode(p, add_special_tokens=False).ids] == model.encode(text, add_special_tokens=False).ids


def test_containment(llm):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    words = item.split()
    near = " ".join([*words[:14], "other"])
    rows = [(1, f"noise before {item.upper()}, and after"), (2, near), (3, " ".join(words[:8])), (4, None), (5, ""), (6, "tiny  test!"), (7, "a tiny test here"), (None, item), (1, item), (8, ("w " * 30_000) + item)]
    items = llm.createDataFrame([(100, item, "x"), (100, item, "x"), (101, "Tiny test", "x"), (102, None, "x"), (103, "", "x"), (None, near, "x")], "item_id long, text string, doc_id string")
    got = containment.find_items(frame(llm, rows), items, slice_chars=60).collect()
    pairs = collections.Counter((r.doc_id, r.item_id) for r in got)
    assert pairs == {(1, 100): 2, (2, 100): 1, (None, 100): 1, (8, 100): 1, (1, None): 2, (2, None): 1, (None, None): 1, (8, None): 1, (6, 101): 1, (7, 101): 1}
    assert {r.containment for r in got if (r.doc_id, r.item_id) == (2, 100)} == {10 / 11}
    clean = containment.drop_contaminated(frame(llm, rows), items)
    assert {r.doc_id for r in clean.collect()} == {3, 4, 5} and clean.columns == frame(llm, rows).columns
    assert containment.find_items(frame(llm, []), items).count() == containment.find_items(frame(llm, rows), items.limit(0)).count() == 0


def test_language_held_out_accuracy(llm):
    docs = table(llm, "/root/testdata/sf0.01", "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = QUERIES["op1_crf_language"](llm, "/root/testdata/sf0.01").collect()
    assert len(found) == len(truth) and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


def test_language_edges(llm):
    model = language.train([("der die und das ist nicht ein " * 30, "de"), ("the and of is not a with " * 30, "en")])
    rows = [(1, None), (2, ""), (3, "123 !"), (4, "The end of a day"), (4, "The end of a day"), (5, "das ist und " * 20_000), (None, "İ der ẞ die")]
    found = language.identify(frame(llm, rows), model)
    assert found.columns[-2:] == ["lang_pred_", "score_"]
    got = collections.Counter((r.doc_id, r["lang_pred_"]) for r in found.collect())
    assert got == {(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (4, "en"): 2, (5, "de"): 1, (None, "de"): 1}
    assert {r.doc_id for r in language.only_known(frame(llm, rows), model, 0.5).collect()} == {4, 5, None}
    assert language.fit(frame(llm, [])).label(["abc"])[0] == ["und"]


def test_every_language_is_learned(llm):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = []
    for i in range(67):
        # Words of one pair of letters; the last two languages occur in long texts only.
        word, times = letters[i % 26] + letters[(i // 26 + 7 * i + 3) % 26], 15_000 if i > 64 else 30
        rows += [(10 * i + j, f"{word * 2} {word * 3} " * times, f"x{i:02}") for j in range(1 if i > 64 else 3)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = language.sample(docs)
    assert {lang for _, lang in taken} == {lang for _, _, lang in rows}
    assert max(len(text) for text, _ in taken) == language.SAMPLE_CHARS
    few = language.sample(docs, total=67)
    assert len(few) == len({lang for _, lang in few}) == 67
    model = language.train([(text[:2_000], lang) for text, lang in taken])
    last = [(text[:200], lang) for _, text, lang in rows if lang > "x60"]
    assert model.label([text for text, _ in last])[0] == [lang for _, lang in last]


def test_forward_backward_is_exact():
    rng = np.random.default_rng(3)
    model = language.Model(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    scores, text = rng.normal(size=(900, 3)) * 3, np.repeat([0, 1, 2, 5], [1, 600, 2, 297])
    found, _ = model.posteriors(scores, text)
    for t in (0, 1, 2, 5):
        own = np.flatnonzero(text == t)
        forward, back = np.zeros((len(own), 3)), np.ones((len(own), 3))
        for i, k in enumerate(own):
            forward[i] = np.exp(scores[k]) * (np.exp(model.start) if i == 0 else forward[i - 1] @ np.exp(model.moves))
            forward[i] /= forward[i].sum()
        for i in range(len(own) - 2, -1, -1):
            back[i] = np.exp(model.moves) @ (np.exp(scores[own[i + 1]]) * back[i + 1])
            back[i] /= back[i].sum()
        wanted = forward * back
        assert np.allclose(found[own], wanted / wanted.sum(axis=1, keepdims=True))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site <a href=x>Home</a></header>
<div class="cookie-notice">We use cookies to do things and many more things here today.</div>
<main><article><header><h1>Title &amp; more</h1></header><p>First <b>para</b>graph.<p>Second<br>line&nbsp; two.<ul><li>one<li>two</ul>
<form><label>Mail</label><input></form><aside class="sidebar">Related things are here in the sidebar text of the page</aside>
<script>var x = "</p>";</script><section id="comments"><p>I like this very much and thank you for the long article.</p></section></article></main>
<!-- <p>no</p> --><footer>c</footer></body></html>"""


def test_main_text(llm):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<p>" + "word " * 50_000, "x"), (4, "u", "<nav><a href=x>A</a></nav>", "x")]
    found = blocks.extract(llm.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    wanted = "Title & more\n\nFirst paragraph.\n\nSecond line two.\n\none\n\ntwo"
    assert [r.text for r in found if r.page_id == 1] == [wanted, wanted]
    assert {r.page_id: r.n_chars for r in found} == {1: len(wanted), 2: 0, 3: 0, None: 249_999, 4: 0}


def test_tree_tells_its_table():
    tree = blocks.grow()
    assert sum(tree.tell(row[:-1]) == bool(row[-1]) for row in blocks.labelled()) / len(blocks.labelled()) > 0.95


def test_articles_of_the_pages(llm, sf):
    import html
    import re

    pages = {r.page_id: r.html for r in table(llm, sf, "pages").collect()}
    for r in QUERIES["op2_text_blocks"](llm, sf).collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", pages[r.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article.replace("<b>", "")))
        assert r.text == "\n\n".join(x for x in parts if x)


def test_lists_as_of(llm):
    day = datetime.date
    entries = [("bad.com", "block", day(2024, 1, 5), 1), ("bad.com", "withdraw", day(2024, 3, 1), 1), ("ok.bad.com", "allow", day(2024, 1, 20), 1), ("bad.com/x", "allow", day(2024, 1, 10), 1), ("bad.com/x", "block", day(2024, 1, 10), 2), (None, "block", day(2024, 1, 1), 1), ("z.org", None, day(2024, 1, 1), 1), ("z.org", "block", None, 1)]
    captures = [(1, "http://www.bad.com/", "2024-01-04"), (2, "http://www.bad.com/", "2024-01-05"), (3, "https://u@OK.bad.com:80/a?b", "2024-02-20"), (4, "http://bad.com/x/y", "2024-01-12"), (5, "http://bad.com/", "2024-03-01"), (6, None, "2024-01-06"), (7, "nonsense", "2024-01-06"), (8, "http://bad.com/", None), (9, "http://notbad.com/", "2024-01-06"), (2, "http://www.bad.com/", "2024-01-05"), (10, "http://z.org/", "2024-02-01")]
    rows = llm.createDataFrame([(i, u, t, "x") for i, u, t in captures], "id int, url string, fetched_at string, blocked string").withColumn("fetched_at", listjoin.F.to_timestamp("fetched_at"))
    found = listjoin.judge(rows, llm.createDataFrame(entries, "key string, action string, day date, nth int")).collect()
    got = collections.Counter((r.id, r["blocked_"], r.list_key) for r in found)
    assert got == {(1, False, None): 1, (2, True, "bad.com"): 2, (3, False, "ok.bad.com"): 1, (4, True, "bad.com/x"): 1, (5, False, None): 1, (6, False, None): 1, (7, False, None): 1, (8, False, None): 1, (9, False, None): 1, (10, False, None): 1}
    none = listjoin.judge(rows, llm.createDataFrame([], "key string, action string, day date, nth int"))
    assert none.count() == len(captures) and none.where("blocked_").count() == 0


def test_lists_at_the_minute_of_the_fetch(llm):
    entries = [("a.com", "block", "2024-01-05 18:00", 1), ("b.com", "block", "2024-01-05 08:00", 1), ("b.com", "withdraw", "2024-01-05 20:00", 1), ("c.com", "block", "2023-11-30 23:59", 1), ("c.com", "allow", "2024-01-05 12:00", 1), ("c.com", "block", "2024-01-05 12:00", 2)]
    wanted = {("a.com", "03:00"): (False, None), ("a.com", "18:00"): (True, "18:00"), ("b.com", "07:59"): (False, None), ("b.com", "12:00"): (True, "08:00"), ("b.com", "20:00"): (False, None), ("c.com", "00:00"): (True, "23:59"), ("c.com", "13:00"): (True, "12:00")}
    rows = llm.createDataFrame([(f"http://{h}/", f"2024-01-05 {t}") for h, t in wanted], "url string, fetched_at string").withColumn("fetched_at", listjoin.F.to_timestamp("fetched_at"))
    said = llm.createDataFrame(entries, "key string, action string, day string, nth int").withColumn("day", listjoin.F.to_timestamp("day"))
    found = listjoin.judge(rows, said).selectExpr("parse_url(url, 'HOST')", "date_format(fetched_at, 'HH:mm')", "blocked", "date_format(list_since, 'HH:mm')")
    assert {(r[0], r[1]): (r[2], r[3]) for r in found.collect()} == wanted


def test_top_k(llm, monkeypatch):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(0, 400)]
    vectors += [(500 + i, [1.0] * 6) for i in range(60)] + [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (None, [1.0] * 6), (7, vectors[7][1])]
    monkeypatch.setattr(topk, "ROW_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    rows = topk.scaled(llm.createDataFrame(vectors, "vec_id long, embedding array<double>"))
    found = topk.top_k(rows, rows.where("vec_id % 50 = 0"), 10).collect()
    real = {i: np.floor(1024 * np.array(v)).astype(np.int64) for i, v in vectors if i is not None and i < 900 and v}
    wanted = set()
    for q in (i for i in real if i % 50 == 0):
        best = sorted(((-int(real[q] @ v), i) for i, v in real.items() if i != q))[:10]
        wanted |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {tuple(r) for r in found} == wanted
    few = topk.scaled(llm.createDataFrame(vectors[:4], "vec_id long, embedding array<double>"))
    assert topk.top_k(few, few.where("vec_id = 0"), 10).count() == 3
    none = topk.scaled(llm.createDataFrame([], "vec_id long, embedding array<double>"))
    assert topk.top_k(none, none, 10).count() == 0


def test_several_vectors_under_one_id(llm, tmp_path):
    rng = np.random.default_rng(8)
    rows = [(i % 150, rng.normal(size=6).tolist()) for i in range(400)]
    llm.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2).write.parquet(str(tmp_path / "embeddings.parquet"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    message, found, _ = difference(con, llm, str(tmp_path), QUERIES["op8_threshold_topk"], SQL["op8_threshold_topk"])
    assert message is None and found == 20


@pytest.mark.parametrize("name", list(SQL))
def test_sql(llm, sf, name):
    message, rows, _ = difference(connect(sf), llm, sf, QUERIES[name], SQL[name])
    assert message is None and rows


def test_pipeline(llm, sf):
    docs = table(llm, sf, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = language.fit(docs)
    told = dict(zip(rows, zip(*model.label([r.text or "" for r in rows.values()]), strict=True), strict=True))
    left = {d: r.text or "" for d, r in rows.items() if told[d][0] != "und" and told[d][1] >= corpus_pipeline.LEAST_SCORE}
    key = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").lower()
    held = collections.Counter(k for t in left.values() for k in {key(x) for x in t.split("\n")})
    left = {d: "\n".join(x for x in t.split("\n") if not key(x) or held[key(x)] < 10) for d, t in left.items()}
    roots = brute_components({d: brute_print(t) for d, t in left.items()}, 3)
    left = {d: t for d, t in left.items() if roots[d] == d}
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    items = [s for r in table(llm, sf, "benchmark").collect() if (s := shingles(containment.words(r.text)))]
    left = {d: t for d, t in left.items() if not any(len(s & shingles(containment.words(t))) >= 0.8 * len(s) for s in items)}
    found = corpus_pipeline.run(llm, sf).collect()
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer()).encode
    wanted = {d: len(encode(t, add_special_tokens=False).ids) + 1 for d, t in left.items()}
    got = collections.Counter()
    for r in found:
        got[r.doc_id] += r.length
    assert got == wanted
