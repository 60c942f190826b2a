"""The ten operators on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracewell.llm import bpe_count, components, decontaminate, html_render, mixing, ngram_join, quality_crf, quotes, rule_lists, token_files, toxicity
from tracewell.llm import queries as llm_queries
from tracewell.llm.components import connected_components

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, node long, k int"
ODD = [None, "", " ", "a", "\n\n", "word " * 3000, "<|endoftext|>x <|endoftext|>", "don't  stop\n\tnow 'tis", "日本語 テキスト 😀", "՘\U000110001", "one two", "é" * 50, "#### $$$$ !!!"]


def docs(spark, rows):
    """(doc_id, text[, source]) rows with columns whose names the operators use themselves."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 1, 0.5, 7, 8, 9) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return docs(spark, [*enumerate(ODD), (3, "a"), (None, "no id"), (None, None)])


def empty(spark):
    return docs(spark, [])


def library():
    return Tokenizer.from_file(PATH)


def test_token_counts(spark, odd):
    tokenizer = library()
    rows = bpe_count.count_tokens(odd, PATH, limit=512).collect()
    want = Counter((d, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for d, t in [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in rows) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)
    assert bpe_count.count_tokens(empty(spark), PATH).count() == 0


def test_counts_of_random_texts():
    tokenizer, count, rng = library(), bpe_count.Counter(PATH), random.Random(2)
    for _ in range(300):
        text = "".join(rng.choices(["the", "ing", " ", "  ", "\n", "'s", "é", "1", "23", ".", "ß", "<|endoftext|>", "😀", "zq"], k=rng.randrange(40)))
        assert count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_counts_of_runs_beyond_a_mebibyte():
    tokenizer, count, rng = library(), bpe_count.Counter(PATH), random.Random(12)
    for text in ("".join(rng.choices(["the", "ing", "zq", "é", "tion"], k=450_000)), "=" * 1_200_000, "\n" * 1_200_000):
        assert len(text.encode()) >= 1_200_000
        assert count(text) == len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_files(spark, odd):
    tokenizer = library()
    rows = sorted(token_files.token_files(odd, PATH).collect(), key=lambda r: r["start"])
    texts = sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (doc_id, text) in zip(rows, texts, strict=True):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert token_files.token_files(empty(spark), PATH).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, u in ((0, 0), (1, 0), (1, 10), (5, 5), (300, 100), (1000, 10**6), (200, 10**12)):
        values = np.sort(rng.integers(0, u + 1, n))
        ef = token_files.EliasFano.of(values, u)
        assert values.tolist() == [ef.select(i) for i in range(n)]
        assert list(ef) == values.tolist()
    assert token_files.EliasFano.of(np.sort(rng.integers(0, 10**6, 10**4)), 10**6).size() * 8 < 10**4 * 9.5  # with its directory
    bounds, ids = token_files.Block.read(token_files.Block.write(np.array([2, 3]), np.array([5, 6, 7], "<u2").tobytes(), 2))
    assert list(bounds) == [2, 3] and ids.tolist() == [5, 6, 7]


def test_join_against_all_pairs(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = list(ODD)
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([4, 12, 40, 150]))
        for _ in range(rng.randrange(1, 12)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    table = docs(spark, [*enumerate(texts), (3, "a"), (None, texts[-1])])
    for n, percent, parts in ((3, 90, 3), (5, 80, 2)):
        sets = [set(ngram_join.shingles(t, n).tolist()) for t in texts]
        root = list(range(len(texts)))

        def top(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in combinations(range(len(texts)), 2):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
        got = ngram_join.jaccard_components(table, n, percent, parts).collect()
        assert len(got) == len(texts) + 2
        assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == {(i, len(s), top(i)) for i, s in enumerate(sets)}
        assert [r["component_id"] for r in got if r["doc_id"] is None] == [top(len(texts) - 1)]
    kept = ngram_join.one_of_each(table, 5, 80)
    assert kept.columns == table.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [i for i in range(len(texts)) if top(i) == i]
    assert ngram_join.jaccard_components(empty(spark), 3, 90).count() == 0 == ngram_join.one_of_each(empty(spark)).count()


def test_join_of_large_components(spark, monkeypatch):
    """Chunks of four sets: members apart from the largest class meet all chunks; repeated ids and rows without one."""
    monkeypatch.setattr(ngram_join, "SETS", (4, 10**6))
    monkeypatch.setattr(ngram_join, "SKETCHES", (6, 10**6))
    monkeypatch.setattr(components, "HOT_ROWS", 10)
    rng, texts, word = random.Random(14), [], iter(range(10**6))
    for _ in range(3):
        now = [f"a{next(word)}" for _ in range(100)]
        for _ in range(40):  # a chain: neighbours link, ends don't
            now = now[4:] + [f"a{next(word)}" for _ in range(4)]
            texts.append(" ".join(now))
    base = [f"b{i}" for i in range(80)]
    for _ in range(60):
        copy = list(base)
        copy[rng.randrange(80)] = f"c{next(word)}"
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    sets = [set(ngram_join.shingles(t, 3).tolist()) for t in texts]
    root = list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
            x, y = sorted((root[a], root[b]))
            root = [x if r == y else r for r in root]
    got = ngram_join.jaccard_components(docs(spark, enumerate(texts)), 3, 80).collect()
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(enumerate(root)) and len(set(root)) < 10


def test_one_of_each_tells_rows_apart_by_text(spark):
    a, b = " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    table = docs(spark, [(1, a), (2, a), (2, b), (2, b), (None, b), (None, "z " + a), (3, None), (3, None), (4, b + " end")])
    kept = sorted((r["doc_id"], r["text"] or "") for r in ngram_join.one_of_each(table, 5, 80).collect())
    assert kept == [(1, a), (2, b), (3, ""), (3, "")]


def test_linked_sets_share_a_signature():
    rng = random.Random(5)
    for _ in range(400):
        base = [f"v{rng.randrange(500)}" for _ in range(rng.choice([3, 9, 30, 100, 600]))]
        other = list(base)
        for _ in range(rng.randrange(1 + len(base) // 20)):
            other[rng.randrange(len(other))] = f"v{rng.randrange(500)}"
        for n, percent, parts in ((3, 90, 3), (5, 80, 2)):
            a, b = (ngram_join.shingles(" ".join(x), n) for x in (base, other))
            common = len(np.intersect1d(a, b))
            if 100 * common >= percent * (len(a) + len(b) - common):
                assert len(np.intersect1d(ngram_join.signatures(a, percent, parts)[0], ngram_join.signatures(b, percent, parts)[0]))


def test_unit_links_of_many_sets():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 120).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(120) > 0.03], rng.integers(0, 2**63, rng.integers(0, 6)).astype(np.uint64)])) for _ in range(40)]
    for blocks in ([0] * 40, [i % 2 for i in range(40)]):
        links = {(a, b) for a, b in combinations(range(40), 2) if (len(set(blocks)) == 1 or blocks[a] != blocks[b]) and 100 * len(c := np.intersect1d(sets[a], sets[b])) >= 90 * (len(sets[a]) + len(sets[b]) - len(c))}
        roots = list(range(40)), list(range(40))
        for root, edges in zip(roots, (links, ngram_join.unit_links(blocks, range(40), sets, 90)), strict=True):
            for a, b in edges:
                x, y = root[a], root[b]
                root[:] = [min(x, y) if r in (x, y) else r for r in root]
        assert roots[0] == roots[1] and len(set(roots[0])) < 40


def test_components(spark):
    edges = [(i + 1, i) for i in range(30)] + [(100, 101), (102, 101), (7, 7)]
    got = {(r["node"], r["root"]) for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(31)} | {(i, 100) for i in (100, 101, 102)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_with_a_hub(spark, monkeypatch):
    monkeypatch.setattr(components, "HOT_ROWS", 5)
    edges = [(5, i) for i in range(6, 60)] + [(100 + i, 200) for i in range(20)] + [(300, 301)]
    got = {(r["node"], r["root"]) for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(i, 5) for i in range(5, 60)} | {(i, 100) for i in [*range(100, 120), 200]} | {(300, 300), (301, 300)}


LABELS = "doc_id long, quality int, toxic int"


def labelled(spark, n=400):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(n):
        good, toxic = i % 3 != 0, i % 4 == 0
        line = [rng.choice(words) for _ in range(60)]
        if toxic:
            line[::20] = ["nasty", "Vile", "nasty!"]
        text = "\n".join([" ".join(line)] * 1 if good else [" ".join(w + "###" for w in line)] * 3)
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    return docs(spark, [*rows, *((1000 + i, t) for i, t in enumerate(ODD)), (5, rows[5][1]), (None, None)]), spark.createDataFrame([*labels, (None, 1, 1), (7, None, None), (9999, 1, 0)], LABELS)


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 0


def test_quality_and_toxicity(spark):
    table, labels = labelled(spark)
    truth = {r["doc_id"]: r for r in labels.collect()}
    field = quality_crf.fit_quality(table, labels)
    model = toxicity.fit_toxicity(table, labels)
    for rows, name, at in ((quality_crf.score_quality(table, field).collect(), "quality", 0.3), (toxicity.score_toxicity(table, model).collect(), "toxic", 0.5)):
        assert len(rows) == table.count()
        assert all(0 <= r["score"] <= 1 and r["held_out"] == held(r["doc_id"]) and r["predicted"] == int(r["score"] >= at) for r in rows)
        tested = [r for r in rows if r["held_out"] and r["doc_id"] < 400]
        assert sum(r["predicted"] == truth[r["doc_id"]][name] for r in tested) > 0.97 * len(tested)
    kept = quality_crf.keep_good(table, field)
    assert kept.columns == table.columns and kept.where("doc_id < 400").count() == sum(i % 3 != 0 for i in range(400)) + (5 % 3 != 0)
    assert 0 < len(model.index) < 5000
    for none in (labels.where("quality = 1 and toxic = 0"), labels.limit(0)):
        assert quality_crf.score_quality(table, quality_crf.fit_quality(table, none)).count() == table.count() == toxicity.score_toxicity(table, toxicity.fit_toxicity(table, none)).count()
    assert quality_crf.score_quality(empty(spark), field).count() == 0 == toxicity.score_toxicity(empty(spark), model).count()


def test_marginals_against_enumeration():
    rng = np.random.default_rng(2)
    field = quality_crf.Field(rng.normal(size=quality_crf.N_FEATURES), rng.normal(size=(2, 2)), 1.0, 0.0)
    for n in (1, 2, 5):
        x = rng.normal(size=(n, quality_crf.N_FEATURES))
        weight, good = 0.0, np.zeros(n)
        for code in range(1 << n):
            y = [code >> i & 1 for i in range(n)]
            p = np.exp(sum(x[i] @ field.weights for i in range(n) if y[i]) + sum(field.links[y[i], y[i + 1]] for i in range(n - 1)))
            weight += p
            good += p * np.array(y)
        assert np.allclose(field.marginals(x), good / weight)


def test_chain_gradient_against_differences():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(3, 4, quality_crf.N_FEATURES)), rng.integers(0, 2, (3, 4))
    mask = np.arange(4) < np.array([4, 2, 3])[:, None]
    w, links = rng.normal(size=quality_crf.N_FEATURES) / 5, rng.normal(size=(2, 2))

    def likelihood(w, links):
        total = 0.0
        for c in range(3):
            n = mask[c].sum()
            score = lambda ys, c=c, n=n: sum(x[c, i] @ w for i in range(n) if ys[i]) + sum(links[ys[i], ys[i + 1]] for i in range(n - 1))
            total += score(y[c]) - np.log(sum(np.exp(score([k >> i & 1 for i in range(n)])) for k in range(1 << n)))
        return total / 3

    g, p = quality_crf.chain_gradient(x, y, mask, w, links)
    for i in range(3):
        step = np.eye(len(w))[i] * 1e-5
        assert np.isclose(g[i], (likelihood(w + step, links) - likelihood(w - step, links)) / 2e-5, atol=1e-6)
    for a, b in ((0, 0), (1, 0)):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        assert np.isclose(p[a, b], (likelihood(w, links + step) - likelihood(w, links - step)) / 2e-5, atol=1e-6)


def brute_statistics(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_rules(spark):
    rng = random.Random(8)
    for text in [t for t in ODD if not t or len(t) < 1000] + [" ".join(rng.choices(["a", "b", "é#"], k=40)) + "\n\na b\na b" for _ in range(50)]:
        assert rule_lists.statistics(text)[:5] == brute_statistics(text)
    table, labels = labelled(spark)
    rules = rule_lists.fit_rules(table, labels)
    assert rules
    rows = rule_lists.apply_rules(table, rules).collect()
    assert len(rows) == table.count()
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert all(r["kept"] == (r["doc_id"] % 3 != 0) for r in rows if r["doc_id"] is not None and r["doc_id"] < 400)
    assert rule_lists.fit_rules(table, labels.limit(0)) == []
    assert rule_lists.apply_rules(empty(spark), rules).count() == 0


def test_mixing(spark):
    rng = random.Random(9)
    sources = ["b", "a", None, "é", "tiny"]
    rows = [(i, "w " * rng.randrange(200), sources[min(3, int(rng.random() ** 2 * 4))]) for i in range(1500)] + [(9000, "one word", "tiny"), (9001, None, "void"), (9002, "", "void"), (4, "again again", "a"), (None, "x y", "b")]
    table = docs(spark, rows)
    got = mixing.taken(table, block_words=500).collect()
    size = lambda t: len((t or "").split())
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, size(t)) for i, t, _ in rows)
    totals = defaultdict(int)
    for _, t, s in rows:
        totals[s] += size(t)
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    goal = dict(zip(order, mixing.targets([totals[s] for s in order], [1 + i % 3 for i in range(len(order))]), strict=True))
    assert sum(goal.values()) == sum(totals.values()) and all(goal[s] <= 3 * totals[s] for s in order)
    by_size = defaultdict(int)
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(1, r["size"]) == 0
        by_size[r["source_size"], r["target"]] += r["taken"]
    for s in order:
        assert abs(by_size[totals[s], float(goal[s])] - goal[s]) <= 200
    again = mixing.taken(table.repartition(7), block_words=500).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    mixed = mixing.mix(table, block_words=500)
    assert mixed.columns == table.columns
    times = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert {r["doc_id"]: r["taken"] // r["size"] for r in got if r["size"] and r["doc_id"] not in (4, None)} == {i: times[i] for i, t, _ in rows if size(t) and i not in (4, None)}
    assert mixing.taken(empty(spark)).count() == 0 == mixing.mix(empty(spark)).count()


def test_splitting_tree(spark):
    def quotas(counts, shards, seed):
        return np.array([c for _, _, c in mixing.split_tree(np.array(counts), 0, shards, seed)])

    few = quotas([40, 0, 7, 120], 8, 1)
    assert few.sum(0).tolist() == [40, 0, 7, 120] and few.min() >= 0
    assert set(few.sum(1)) <= {20, 21}
    many = sum(quotas([10, 30], 4, i) for i in range(400)) / 400
    assert np.allclose(many[:, 0], 2.5, atol=0.25)
    # split in tasks below any number of nodes, the ranges are those of the whole tree
    counts = np.array([900, 0, 41, 3000])
    whole = quotas(counts, 37, 3)
    ends = np.cumsum(whole, axis=0)
    want = {(k, s, ends[s, k] - whole[s, k], ends[s, k]) for s in range(37) for k in range(4) if whole[s, k]}
    for top in (1, 5, 512):
        assert {tuple(r) for r in mixing.quota_ranges(spark, counts, 37, 3, top).collect()} == want
    assert mixing.quota_ranges(spark, np.zeros(0, np.int64), 4, 3).count() == 0


BENCH = [(1, "The quick brown fox jumps over the lazy dog while seventeen wizards quietly brew potions near the old stone bridge at dawn"), (2, "An entirely different question about prime numbers, rivers and the height of mountains in winter"), (3, None), (4, ""), (5, "short"), (2, "A second row of the same item that also matters for the search of passages")]


def test_decontamination(spark):
    bench = spark.createDataFrame([(i, t, "x") for i, t in BENCH], "item_id long, text string, doc_id string")
    fill = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod " * 5
    fox = BENCH[0][1]
    rows = [(1, fill + fox + fill), (2, fill), (3, fill + fox.upper().replace(" ", "\n ")), (4, fill + fox.replace("q", "k").replace("wizards", "wizzards") + fill), (5, fox[:60]), (6, fill + BENCH[1][1]), (7, "x" + BENCH[5][1]), (1, fill + fox + fill), *((100 + i, t) for i, t in enumerate(ODD)), (None, fox), (8, fill * 500 + fox)]
    table = docs(spark, rows)
    got = Counter((r["doc_id"], tuple(r["item_ids"])) for r in decontaminate.contaminated(table, bench).collect())
    assert got == Counter([(1, (1,)), (1, (1,)), (3, (1,)), (4, (1,)), (6, (2,)), (7, (2,)), (None, (1,)), (8, (1,))])
    blocks = Counter((r["doc_id"], tuple(r["item_ids"])) for r in decontaminate.contaminated(table, bench, block_chars=100).collect())
    assert blocks == got
    clean = decontaminate.without_benchmark(table, bench, block_chars=100)
    assert clean.columns == table.columns and sorted(r["doc_id"] for r in clean.collect()) == sorted([2, 5, *range(100, 100 + len(ODD))])
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(table, bench.limit(0)).count() == 0


def test_decontamination_by_items_without_id(spark):
    texts = [BENCH[0][1], BENCH[1][1]]
    bench = spark.createDataFrame([(None, t) for t in [*texts, None]], "item_id long, text string")
    table = docs(spark, [(1, "x " + texts[0]), (2, "clean text of its own"), (3, texts[1] + " y")])
    for chars in (50, 10**6):
        assert [r["doc_id"] for r in decontaminate.without_benchmark(table, bench, block_chars=chars).collect()] == [2]


def test_contaminated_has_a_row_for_each_row_at_any_size_of_blocks(spark):
    rng = random.Random(15)
    passage = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(20))
    items = [passage() for _ in range(6)]
    benchmark = spark.createDataFrame([*enumerate(items), (9, items[0]), (None, "x" * 90), (10, "-" * 5000)], "item_id long, text string")
    table = docs(spark, [(1, "start " + " middle ".join(items)), (2, items[2]), (2, items[2]), (3, passage()), (4, None), (5, "=" * 5000), (6, "-" * 20000)])
    want = [(1, [0, 1, 2, 3, 4, 5, 9]), (2, [2]), (2, [2]), (6, [10])]
    for size in (10**6, 100):
        rows = decontaminate.contaminated(table, benchmark, size).collect()
        assert sorted((r["doc_id"], r["item_ids"]) for r in rows) == want


def test_banded_alignment_against_the_whole_table():
    rng = random.Random(16)
    for _ in range(300):
        segment = "".join(rng.choices("ab", k=rng.randrange(3, 14)))
        text = "".join(rng.choices("ab", k=rng.randrange(1, 25)))
        diagonal, width, most = rng.randrange(-4, 12), rng.randrange(1, 8), rng.randrange(4)
        cost = {(0, j): 0 if diagonal <= j < diagonal + width else 99 for j in range(len(text) + 1)}
        for i in range(1, len(segment) + 1):
            for j in range(len(text) + 1):
                inside = diagonal <= j - i < diagonal + width
                steps = [cost[i - 1, j] + 1, *((cost[i - 1, j - 1] + (segment[i - 1] != text[j - 1]), cost[i, j - 1] + 1) if j else ())]
                cost[i, j] = min(steps) if inside else 99
        want = min(cost[len(segment), j] for j in range(len(text) + 1)) <= most
        assert decontaminate.edits_within(decontaminate.codes_of(segment), decontaminate.codes_of(text), diagonal, width, most) == want


def test_segments_found_within_their_edits():
    rng = random.Random(3)
    letters = "abcdefghijklmnop"
    index = decontaminate.Index(decontaminate.segments_of(1, "".join(rng.choices(letters, k=80))))
    segment = index.segments[0]
    for _ in range(200):
        text = list(segment.text)
        for _ in range(segment.edits):
            k, what = rng.randrange(len(text)), rng.randrange(3)
            text[k : k + (what < 2)] = [] if what == 0 else ["#"] if what == 1 else ["@"]
        assert index.find("z" * rng.randrange(300) + "".join(text) + "y" * rng.randrange(300)) == [1]


def test_html(spark):
    pages = [
        (1, "<html><head><title>no</title></head><body><h1>A &amp; b</h1><p>One<p>two <b>bold</b> text<br>next<script>x</script><div hidden>no</div><span style='display: none'>no</span></body>"),
        (2, "<ul><li>a<li>b<ol start=3><li>x<li>y</ol></ul>end"),
        (3, "<table><caption>Cap<tr><th>Name<th>V<tr><td>long name<td>1<tr><td>s<td><table><tr><td>in<td>ner</table></table>after"),
        (4, "<pre>  a\n   b</pre>x<hr>z"),
        (5, None), (6, ""), (7, "plain <"), (8, "<div>" * 3000 + "deep" + "</p></td>"), (9, "<table><tr><td>" * 200 + "x"), (7, "plain <"),
    ]
    table = spark.createDataFrame([(i, "u", h, "x") for i, h in pages], "page_id long, url string, html string, text string")
    got = [(r["page_id"], r["text"]) for r in html_render.render_pages(table).collect()]
    want = {1: "A & b\n\nOne\n\ntwo bold text\nnext", 2: "- a\n- b\n  3. x\n  4. y\n\nend", 3: "Cap\nName      | V\nlong name | 1\ns         | in | ner\n\nafter", 4: "  a\n   b\n\nx\n\n---\n\nz", 5: "", 6: "", 7: "plain <", 8: "deep", 9: "x"}
    assert sorted(got) == sorted([*want.items(), (7, "plain <")])
    assert html_render.render_pages(table.limit(0)).count() == 0


def test_html_keeps_the_words_of_broken_tables():
    for page, want in (
        ("<table><tr><td>1</td></tr><td>2</td></table>", "1\n2"),
        ("<table><tr><td>0<tr><form><td>1<td>2</form></table>", "0\n1 | 2"),
        ("<table><tr><td>0<form><tr><td>1</table>", "0\n1"),
        ("a<table>b<tr><td>1<div>2</div></td>c</tr><p>d</p></table>e", "a\nb c\n\nd\n\n1 2\n\ne"),
        ("<table><td>1<td><table><td>2<td>3</table><tr><td>4</table>", "1 | 2 | 3\n4"),
        ("<table><noscript><tr><td>no</noscript><tr><td>1</table>2", "1\n\n2"),
        ("x<svg><title>no</title><defs><text>no</text></defs><text>s</text><text>t</text></svg>", "x\ns\nt"),
        ("<p><math><mi>a</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math><object data=x>b</object>", "a=1b"),
    ):
        assert html_render.render(page) == want
    rng = random.Random(7)
    tags = "table /table tr /tr td /td th caption /caption colgroup col tbody /tbody thead form /form div /div p /p b /b li ul /ul svg /svg x /x".split()
    for _ in range(3000):
        parts, words = [], []
        for k in range(rng.randrange(2, 40)):
            if rng.random() < 0.4:
                words.append(f"w{k}w")
                parts.append(rng.choice(["", " "]) + words[-1])
            else:
                parts.append(f"<{rng.choice(tags)}>")
        text = html_render.render("<table>" + "".join(parts))
        assert sorted(re.findall(r"w\d+w", text)) == sorted(words), parts


def test_quotes(spark):
    rows = [
        (1, 0, "user", "How do I sort a list?\n\nIt has many items."),
        (1, 1, "assistant", "> How do I  sort a LIST?\nUse sorted."),
        (1, 2, "user", "> > How do I sort a list?\n> Use sorted.\nThanks"),
        (1, 3, "user", "Something else"),
        (2, 0, "user", "> use sorted.\nfrom elsewhere"),
        (2, 1, "user", "> nobody said this\nx"),
        (2, 1, "user", "> nobody said this\nx"),
        (None, 0, "user", "> Something else\ny"), (3, None, "user", "z"), (4, 0, "user", None), (4, 1, "user", ""), (4, 2, "user", ">\n>  \nw"), (5, 0, "user", "long\n" * 3000 + "> long"),
    ]
    table = spark.createDataFrame([(*r, 1, "b") for r in rows], "conv_id long, turn long, role string, text string, hash int, body string")
    got = quotes.conversations(table).collect()
    assert len(got) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in got}
    assert by[1, 1]["body"] == "Use sorted." and by[1, 1]["reply_to"] == 0
    assert by[1, 2]["body"] == "Thanks" and by[1, 2]["reply_to"] == 1 and by[1, 2]["place"] == 2 and by[1, 2]["n_quotes"] == 2 == by[1, 2]["n_linked"]
    assert by[1, 3]["reply_to"] is None and by[1, 3]["thread_turn"] == 3 and by[1, 3]["depth"] == 0
    assert (by[2, 0]["quotes_conv_id"], by[2, 0]["quotes_turn"], by[2, 0]["reply_to"]) == (1, 1, None)
    assert by[2, 1]["n_quotes"] == 1 and by[2, 1]["n_linked"] == 0
    assert by[None, 0]["n_quotes"] == 0 and by[None, 0]["body"] == "y"
    assert by[4, 0]["body"] == "" and by[4, 2]["body"] == "w" and by[4, 2]["n_quotes"] == 0
    assert [r["turn"] for r in got if r["conv_id"] == 1] == [0, 1, 2, 3]
    assert quotes.conversations(table.limit(0)).count() == 0


def test_quotes_of_lines(spark):
    rows = [
        (1, 0, "a\nb\nc"), (1, 1, "> b\nanswer"), (1, 2, "> a\nto a\n> b\n> c\nto both"), (1, 3, "> answer\n> cut here\nx"),
        (2, 0, "first\r\nthanks\r\n\r\nlast"), (2, 1, "thanks"), (2, 2, "> Thanks\nwelcome"), (2, 3, "> to both\n> first\ny"), (2, 4, "> b\n> nowhere\ny"),
    ]
    table = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.threads(table).collect()}
    assert {k: r["reply_to"] for k, r in got.items()} == {(1, 0): None, (1, 1): 0, (1, 2): 0, (1, 3): 1, (2, 0): None, (2, 1): None, (2, 2): 1, (2, 3): 0, (2, 4): None}
    assert (got[1, 2]["n_quotes"], got[1, 2]["n_linked"], [got[1, t]["place"] for t in range(4)]) == (2, 2, [0, 1, 3, 2])
    assert got[2, 3]["quotes_conv_id"] is None and (got[2, 4]["quotes_conv_id"], got[2, 4]["quotes_turn"]) == (1, 0)


def test_threads_have_the_depth_of_their_quotes(spark):
    rows = [(1, t, "user", (f"> message number {t - 1} says\n" if t else "") + f"message number {t} says") for t in range(20)]
    got = quotes.threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all(r["depth"] == r["turn"] and r["thread_turn"] == 0 and r["place"] == r["turn"] for r in got)


def test_places_against_sorted_paths(spark):
    """Random forests with chains, many answers to one message, and turns of several blocks of siblings."""
    rng = random.Random(23)
    ups = {(1, t): t - 1 for t in range(1, 120)} | {(2, t): 0 for t in range(50, 20_000, 97)}
    for conv, most in ((3, 3), (4, 40), (-5, 1000)):
        ups |= {(conv, t): rng.randrange(max(-20, t - most), t) for t in range(-19, 200) if rng.random() < 0.9}
    # what is answered but answers nothing is the first message of a thread
    path = lambda c, t: [*(path(c, ups[c, t]) if (c, t) in ups else []), t]
    by_thread = defaultdict(set)
    for (c, t), up in ups.items():
        first = path(c, t)
        by_thread[c, first[0]] |= {tuple(first), (first[0],)}
    want = {(c, p[-1]): n for (c, _), paths in by_thread.items() for n, p in enumerate(sorted(paths)) if len(p) > 1}
    table = spark.createDataFrame([(c, t, up) for (c, t), up in ups.items()], "conv_id long, turn long, up long")
    assert {(r["conv_id"], r["turn"]): r["place"] for r in quotes.places(table).collect()} == want
    assert quotes.places(table.limit(0)).count() == 0


def test_quotes_against_sql(spark):
    rng = random.Random(5)
    rows = [(1, 1, "user", None), (1, 1, "user", "> > A b\n>\n> c"), (1, 1, "user", "> > A b\n>\n> c"), (None, 0, "user", "> c\nd"), (2, None, "x", "a b"), (3, 0, "user", "a b\n\nc\n")]
    for conv in range(1, 9):
        said = []
        for turn in range(14):
            lines = []
            for _ in range(rng.randrange(4)):
                source = rng.choice(said[-2:]) if said and rng.random() < 0.8 else "\n".join(rng.choice("abcd") + " " + rng.choice("EFG") for _ in range(rng.randrange(1, 4)))
                part = rng.choice([source, rng.choice(source.split("\n")), rng.choice(source.split("\n\n"))])
                mark = rng.choice(["> ", ">", " > > ", "\t>> "]) if rng.random() < 0.6 else ""
                lines += [mark + line for line in part.split("\n")] + ([""] if rng.random() < 0.4 else [])
            said.append(rng.choice(["\n", "\r\n"]).join([*lines, f"new {conv} {turn}"]))
            rows.append((conv, turn, rng.choice(["user", "assistant"]), said[-1]))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = quotes.conversations(table)
    con = duckdb.connect()
    con.register("conversations", table.toArrow())
    want = con.execute(llm_queries.SQL["op3_quote_linking"])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    want = sorted(repr(r) for r in want.fetchall())
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want
    found = got.select("n_linked", "depth").collect()
    assert sum(r["n_linked"] for r in found) > 50 and max(r["depth"] for r in found) > 2


def test_quotes_use_no_python(spark):
    table = spark.createDataFrame([(1, 0, "user", "> a\nb")], "conv_id long, turn long, role string, text string")
    plan = quotes.answers(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_held_out_is_spark_and_python_alike(spark):
    from tracewell.llm.common import held_out

    assert all(r["h"] == held(r["doc_id"]) for r in spark.range(50).select(F.col("id").alias("doc_id")).withColumn("h", held_out()).collect())


def test_targets_by_another_way():
    """A level x such that min(3 * size, x * weight) add up to all words, by bisection."""
    rng = random.Random(17)
    for _ in range(50):
        sizes = [rng.choice([0, 1, 5, 100, 10_000, 10**6]) for _ in range(rng.randrange(1, 9))]
        weights = [i % 3 + 1 for i in range(len(sizes))]
        low, high, total = 0.0, 4.0 * sum(sizes), sum(sizes)
        for _ in range(200):
            x = (low + high) / 2
            low, high = (x, high) if sum(min(3 * s, x * w) for s, w in zip(sizes, weights, strict=True)) < total else (low, x)
        for t, s, w in zip(mixing.targets(sizes, weights), sizes, weights, strict=True):
            assert abs(float(t) - min(3 * s, high * w)) <= 1e-6 * (1 + total)


def test_draws_are_dealt_to_shards_by_the_tree(spark):
    rows = mixing.taken(docs(spark, [(i, "w " * (i % 50 + 1), "abc"[i % 3]) for i in range(900)]), block_words=200, shards=5).collect()
    assert all(len(r["shards"]) * r["size"] == r["taken"] and set(r["shards"]) <= set(range(5)) for r in rows)
    assert len({x for r in rows for x in r["shards"]}) == 5


def test_ftrl_against_one_coordinate_at_a_time():
    """The update rule in plain Python on a few examples, and scores from its weights."""
    rng = np.random.default_rng(18)
    examples = [(np.unique(rng.integers(0, 12, 5)), int(rng.random() < 0.4)) for _ in range(40)]
    model = toxicity.ftrl(examples, l1=0.5, epochs=3)
    z, n, last = defaultdict(float), defaultdict(float), 1 << toxicity.BITS

    def weight(i):
        if i == last:
            return -z[i] / (1 + n[i] ** 0.5)
        return 0.0 if abs(z[i]) <= 0.5 else -(z[i] - np.sign(z[i]) * 0.5) / (1 + n[i] ** 0.5 + 0.1)

    order = np.random.default_rng(5)
    for _ in range(3):
        for k in order.permutation(len(examples)):
            found, y = [*examples[k][0].tolist(), last], examples[k][1]
            w = {i: weight(i) for i in found}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for i in found:
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) * w[i]
                n[i] += g * g
    assert abs(model.bias - weight(last)) < 1e-9
    assert np.allclose(model.dense()[:12], [weight(i) for i in range(12)], atol=1e-6)


def test_sample_bounds_keep_whole_documents(spark):
    from tracewell.llm.common import bounded

    rows = spark.createDataFrame([(i, 10) for i in range(20)], "doc_id long, n int")
    assert bounded(rows, "n", 55).count() == 5 and bounded(rows, "n", 5).count() == 0


def test_a_very_large_row_of_the_sample_changes_nothing_but_itself(spark):
    from tracewell.llm.common import bounded

    rows = [(i, 10) for i in range(20)]
    plain = {r["doc_id"] for r in bounded(spark.createDataFrame(rows, "doc_id long, n int"), "n", 1000).collect()}
    for large in (700, 10**6):
        for k in range(20, 40):  # wherever its hash comes
            found = {r["doc_id"] for r in bounded(spark.createDataFrame([*rows, (k, large)], "doc_id long, n int"), "n", 1000).collect()}
            assert found - {k} == plain and (k in found) == (large <= 800)


def test_quality_with_a_very_long_labelled_text(spark):
    table, labels = labelled(spark, 150)
    long = table.withColumn("text", F.when(F.col("doc_id") == 4, F.repeat(F.lit("\n"), quality_crf.FIT_LINES + 1)).otherwise(F.col("text")))
    short = table.where("doc_id is null or doc_id != 4")
    scores = lambda t, fit: {(r["doc_id"], r["score"]) for r in quality_crf.score_quality(t, quality_crf.fit_quality(fit, labels)).collect()}
    assert scores(short, long) == scores(short, short)


def test_chains_of_a_long_text_weigh_as_one():
    x, y, mask = np.random.default_rng(1).normal(size=(3, 4, quality_crf.N_FEATURES)), np.ones((3, 4), int), np.ones((3, 4), bool)
    w, links = np.full(quality_crf.N_FEATURES, 0.1), np.zeros((2, 2))
    whole = quality_crf.chain_gradient(x, y, mask, w, links, np.array([1.0, 0.5, 0.5]))
    parts = [quality_crf.chain_gradient(x[k : k + 1], y[k : k + 1], mask[k : k + 1], w, links) for k in range(3)]
    for k in (0, 1):
        assert np.allclose(whole[k] * 3, parts[0][k] + 0.5 * parts[1][k] + 0.5 * parts[2][k])


def test_contaminated_by_items_without_id_and_by_long_items(spark):
    texts = [BENCH[0][1], BENCH[1][1]]
    bench = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (5, texts[0]), (6, " ".join(str(i * i) for i in range(3000)) + texts[1])], "item_id long, text string")
    table = docs(spark, [(1, "x " + texts[0]), (2, "clean text of its own"), (3, texts[1] + " y")])
    for chars in (300, 10**7):
        rows = decontaminate.contaminated(table, bench, block_chars=chars).collect()
        assert sorted((r["doc_id"], r["item_ids"]) for r in rows) == [(1, [None, 5]), (3, [None, 6])]


def test_contaminated_against_alignment_of_every_segment(spark):
    """Every text against every segment by a whole table of edits, without filters."""
    rng = random.Random(19)
    sentence = lambda n: " ".join("".join(rng.choices("abcdefghijkl", k=rng.randrange(2, 9))) for _ in range(n))
    items = [(i, sentence(rng.choice([3, 8, 25]))) for i in range(8)]

    def spoiled(text, n):
        text = list(text)
        for _ in range(n):
            k = rng.randrange(len(text))
            text[k : k + rng.randrange(2)] = rng.choice(["", "z", " "])
        return "".join(text)

    rows = [(k, " ".join([sentence(6), spoiled(items[k % 8][1], rng.randrange(12)), sentence(4)])) for k in range(60)] + [(100 + k, sentence(30)) for k in range(10)]

    def occurs(segment, text):
        cost = [0] * (len(text) + 1)
        for i, c in enumerate(segment, 1):
            new = [i]
            for j, t in enumerate(text, 1):
                new.append(min(cost[j] + 1, new[-1] + 1, cost[j - 1] + (c != t)))
            cost = new
        return min(cost)

    want = {}
    for k, text in rows:
        found = [i for i, item in items if any(occurs(s.text, decontaminate.normal(text)) <= s.edits for s in decontaminate.segments_of(i, item))]
        if found:
            want[k] = found
    got = {r["doc_id"]: r["item_ids"] for r in decontaminate.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 20 and got == want


def test_toxicity_is_calibrated_for_few_positives():
    rng = np.random.default_rng(20)
    examples = [(np.unique(np.concatenate([rng.integers(100, 5000, 40), rng.integers(0, 20, 2 if y else 0)])), y) for y in [int(k % 12 == 0) for k in range(1200)]]
    model = toxicity.fit(examples)
    p = toxicity.sums(model, examples) > 0
    y = np.array([y for _, y in examples], bool)
    assert p[y].mean() > 0.95 and p[~y].mean() < 0.02


def test_html_spans_fields_and_depth():
    assert html_render.render("<table><tr><td colspan=2>Total<td>5<tr><td>1<td>2<td>3</table>") == "Total |   | 5\n1     | 2 | 3"
    assert html_render.render("<table><tr><td rowspan=2>x<td>y<tr><td>p</table>") == "x | y\n  | p"
    assert html_render.render("a<select><option>one<option selected>two</select>b<textarea>c d</textarea>") == "a two bc d"
    assert html_render.render("<select multiple><option>one<option>two</select>") == "one two"
    assert html_render.render("<table><tr><td>" * 3000 + "deep") == "deep"
    for page in ("<div>" * 40_000 + "x", "<div>" * 40_000 + "</p>" * 40_000 + "x"):  # quadratic time would take minutes
        assert html_render.render(page) == "x"


def test_html_self_closed_elements_of_svg_and_time_of_definitions():
    import time

    for inner in ("desc", "defs", "title", "mask"):
        assert html_render.render(f"<p>a<svg><{inner}/><text>Visible</text></svg>b").split() == "a Visible b".split()
    assert html_render.render("<svg/>x<math/>y<div/>z").split() == ["xy", "z"]
    began = time.time()
    html_render.render("<div>" * 20_000 + "<svg>" + "<mask>" * 20_000)
    assert html_render.render("<div>" * 20_000 + "<mask>" * 20_000 + "x") == "x" and time.time() - began < 10


def test_html_inherited_visibility():
    for page, want in (
        ('<div style="visibility:hidden">a<span style="visibility:visible">b</span><p>c<i style="visibility: inherit">d</i></p></div>e', "b\n\ne"),  # a paragraph's distance stays
        ('<ul style="visibility:hidden"><li>a<li style="visibility:visible">b<li>c<b style="visibility:visible">d</b></ul>', "- b\n  d"),
        ('<table><tr><td>1<td style="visibility:hidden">no<td>3<tr style="visibility:hidden"><td>x<td>y<tr style="visibility:collapse"><td style="visibility:visible">z<tr><td>4<td>5<td>6</table>', "1 |   | 3\n4 | 5 | 6"),
        ('<p style="visibility:hidden;visibility:visible">a</p><p style="backface-visibility:hidden">b</p><hr style="visibility:hidden"><img alt=no style="visibility:hidden">', "a\n\nb"),
        ('<select style="visibility:hidden"><option>no</select>x', "x"),
    ):
        assert html_render.render(page) == want, (page, html_render.render(page))


def test_html_output_and_time_are_linear():
    """Wide cells, spans, deep lists and deep tables: each page doubled gives at most about double the text."""
    import time

    wide = lambda n: "<table>" + "".join(f"<tr><td>{'w' * (50 if k % 2 else 5)}<td>{'x' * (n * 20 if k == 0 else 1)}<td>z" for k in range(n)) + "</table>"
    spans = lambda n: "<table><tr><td colspan=9999>a" + "<td>b" * n + "<tr><td rowspan=9999>c" * n + "</table>"
    tall = lambda n: "<table><tr>" + "<td rowspan=9999>c" * n + "<tr><td>d" * n + "</table>"
    lists = lambda n: "<ul><li>x" * n
    tables = lambda n: "<table><tr><td>x" * n
    inline = lambda n: "<b>word</b> " * n
    for page in (wide, spans, tall, lists, tables, inline):
        small, large = page(4000), page(8000)
        began = time.time()
        a, b = html_render.render(small), html_render.render(large)
        assert time.time() - began < 20, large[:40]
        assert len(b) <= 2.2 * len(a) + 100 and len(b) <= 45 * len(large), (len(a), len(b), len(large))
    assert html_render.render(lists(3000)).count("x") == html_render.render(tables(3000)).count("x") == 3000
    assert html_render.render(spans(30)).count("b") == 30 == html_render.render(spans(30)).count("c")
    assert html_render.render(f"<table><tr><td>{'w' * 60}<td>1<tr><td>v<td>2</table>") == "w" * 60 + " | 1\n" + "v".ljust(40) + " | 2"
