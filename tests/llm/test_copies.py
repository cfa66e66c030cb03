"""Repeats, similar documents, lines, benchmark passages and neighbours against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gradeline.llm import bpe, jaccard, lines, neighbours, repeats, secrets, tiling
from gradeline.llm.common import row_key
from gradeline.llm.graph import components

WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="module")
def texts():
    """Random texts, copies, near copies, shared passages, stutters."""
    choose = random.Random(3)
    base = [" ".join(choose.choices(WORDS, k=choose.randint(1, 150))) for _ in range(40)]
    passage = " ".join(choose.choices(WORDS, k=60))
    out = [*base, *base[:8], base[0], "a " * 90, "a " * 40 + "b"]
    out += [f"{base[i]} {passage} {base[i + 1]}" for i in range(5)]
    for i in range(12):
        words = base[30].split() + base[31].split() + base[32].split()
        for _ in range(i % 4):
            words[choose.randrange(len(words))] = choose.choice(WORDS)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("least", [35, 6])
def test_repeats(docs, texts, least):
    words = [repeats.WORD.findall(t) for t in texts]
    starts = Counter(tuple(w[i : i + least]) for w in words for i in range(len(w) - least + 1))
    got = {r["doc_id"]: r for r in repeats.remove_repeats(docs, least_words=least).collect()}
    for i, w in enumerate(words):
        gone = set()
        for s in range(len(w) - least + 1):
            if starts[tuple(w[s : s + least])] > 1:
                gone.update(range(s, s + least))
        assert got[i]["n_words"] == len(w) and got[i]["n_removed"] == len(gone)
        assert got[i]["kept_text"] == " ".join(x for j, x in enumerate(w) if j not in gone)
        inside = {j for s, e in zip(got[i]["repeat_starts"], got[i]["repeat_ends"]) for j in range(s, e)}
        assert inside == gone


def test_repeats_of_odd_rows(odd_docs, no_docs):
    rows = repeats.remove_repeats(odd_docs, least_words=3).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r["n_removed"] for r in rows if r["text"] == "one two three") == [3, 3, 3]
    assert repeats.remove_repeats(no_docs).count() == 0


def _shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def test_similar_documents(docs, texts):
    sets = [_shingles(t) for t in texts]
    linked = defaultdict(set)
    for i, j in combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
            linked[i].add(j)
            linked[j].add(i)
    root = list(range(len(texts)))
    for _ in texts:
        root = [min([root[i], *[root[j] for j in linked[i]]]) for i in range(len(texts))]
    got = {r["id"]: r for r in jaccard.similar_documents(docs).collect()}
    assert {i: (r["class_id"], r["n_links"]) for i, r in got.items()} == {
        i: (root[i], len(linked[i])) for i in range(len(texts))
    }
    kept = {r["doc_id"] for r in jaccard.one_of_each(docs).collect()}
    assert kept == set(root)


def test_similar_documents_in_large_nodes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    base = random.Random(5).choices(WORDS, k=200)
    rows = [(i, " ".join([*base[:k], f"x{i}", *base[k + 1 :]])) for i, k in enumerate(range(20, 80))]
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["class_id"] for r in got} == {0}
    assert {r["n_links"] for r in got} == {len(rows) - 1}


def test_similar_documents_of_odd_rows(odd_docs, no_docs):
    rows = jaccard.similar_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert sorted(r["n_links"] for r in rows) == [0] * 7 + [2, 2, 2]
    kept = jaccard.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("text = 'one two three'").count() == 1
    assert jaccard.similar_documents(no_docs).count() == 0


def test_roots_reach_the_recall():
    assert jaccard.roots_for(0.9999, 0.8) > jaccard.roots_for(0.99, 0.8) > 1


def test_components(spark):
    choose = random.Random(2)
    edges = [(f"n{choose.randrange(300):03}", f"n{choose.randrange(300):03}") for _ in range(250)]
    edges += [(f"p{i:03}", f"p{i + 1:03}") for i in range(40)] + [("hub", f"s{i}") for i in range(50)]
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: r for x, r in root.items() if x in got}
    assert set(root) - set(got) <= {a for a, b in edges if a == b}


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _normalised(line):
    return " ".join("".join(c if c.isalnum() else " " for c in line.lower()).split())


def _without_repeats(rows, links):
    """What stays of the texts of ``rows`` if the normalised lines that ``links`` connect are one."""
    root = {_normalised(line): _normalised(line) for _, text in rows for line in text.split("\n")}
    for _ in root:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    seen, kept = {""}, {}
    for i, text in rows:
        kept[i] = []
        for line in text.split("\n"):
            kind = root[_normalised(line)]
            if not kind or kind not in seen:
                seen.add(kind)
                kept[i].append(line)
    return {i: "\n".join(x) for i, x in kept.items()}


def test_lines(spark):
    """Every link at 0.8, whatever the fingerprints are, with one, two and three words of 40 changed and in short lines."""
    choose = random.Random(4)
    base = [" ".join(choose.choices(WORDS, k=40)) for _ in range(14)]
    pool = base + [b.upper() + "!" for b in base[:6]] + ["short one", "", "two", "Two."]
    for n, b in enumerate(base[5:14]):
        for _ in range(3):
            words = b.split()
            for _ in range(1 + n % 3):
                words[choose.randrange(40)] = choose.choice(WORDS)
            pool.append(" ".join(words))
    pool += ["wonderful little houses stand here", "wonderful little horses stand here"]
    rows = [(i, "\n".join(choose.choices(pool, k=6))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kinds = sorted({_normalised(line) for _, text in rows for line in text.split("\n")} - {""})
    links = [(a, b) for a, b in combinations(kinds, 2) if _distance(a, b) <= 0.2 * max(len(a), len(b))]
    assert len(links) > 10
    want = _without_repeats(rows, links)
    got = {r["doc_id"]: r for r in lines.remove_repeated_lines(df).collect()}
    # A document of which all lines go is an empty text, like one whose only line is empty.
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_lines"] == 6 for r in got.values())


def test_recall_of_lines_against_brute_force(spark, sf_dir):
    """Of all pairs of the table's lines with an edit similarity of 0.8 at least 0.95 end in one group."""
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect() if r["text"]]
    kinds = sorted({_normalised(line) for text in texts for line in text.split("\n")} - {""}, key=len)
    df = spark.createDataFrame([(i, k) for i, k in enumerate(kinds) if len(k) < 600], "id long, norm string").withColumn("n", F.length("norm"))
    df = df.repartition(64).cache()
    # A character that only one line has needs an edit, two edits can mend one of each line at most.
    letters = "etainrschuobdlg vmkpwfyzäöü"
    bag = F.array(*[F.length("norm") - F.length(F.replace("norm", F.lit(c), F.lit(""))) for c in letters])
    one, two = (df.withColumn("bag", bag).select(*[F.col(c).alias(f"{c}{s}") for c in ("id", "norm", "n", "bag")]) for s in "ab")
    most = F.floor(F.col("nb") * 0.2 + 1e-9).cast("int")
    apart = F.aggregate(F.zip_with("baga", "bagb", lambda x, y: F.abs(x - y)), F.lit(0), lambda x, y: x + y)
    met = two.join(F.broadcast(one), (F.col("ida") < F.col("idb")) & (F.col("nb") - F.col("na") <= most))
    links = met.filter(apart <= 2 * most).filter(lines._distance_within(F.col("norma"), F.col("normb"), most))
    links = [(r["norma"], r["normb"]) for r in links.select("norma", "normb").collect()]
    rows = spark.createDataFrame([(i, k, False) for i, k in enumerate(kinds)], "id long, text string, no_id boolean")
    rows = rows.withColumn("k1", F.col("id")).withColumn("k2", F.col("id"))
    each = lines._lines(rows, 1)
    at = F.struct("no_id", "id", "k1", "k2", "line_no").alias("at")
    groups = lines.line_groups(each.select("h1", "h2", at), lines._keys(rows, 1), rows, 0.8)
    names = each.select("id", lines._name().alias("node")).join(groups, "node").collect()
    root = {kinds[r["id"]]: r["root"] for r in names}
    found = sum(a in root and root[a] == root.get(b) for a, b in links)
    print("recall", found, len(links))
    assert len(links) > 20 and found >= 0.95 * len(links)


def test_lines_that_the_first_does_not_connect_are_linked(spark, monkeypatch):
    """All lines share a key; the one of the least hash is like none or some, and only texts decide who is linked."""
    monkeypatch.setattr(lines, "TILE", 2)
    texts = ["e" * 100, "a" * 100, "a" * 85 + "b" * 15, "a" * 70 + "b" * 30, "c" * 100, "c" * 90 + "d" * 10, "a" * 130]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = docs.withColumn("no_id", F.lit(False)).withColumn("k1", F.col("id")).withColumn("k2", F.col("id"))
    places = [(i, 10, False, i, i, i, 0) for i, t in enumerate(texts)]
    found = spark.createDataFrame(places, "h1 long, h2 long, no_id boolean, id long, k1 long, k2 long, line_no int")
    found = found.select("h1", "h2", F.struct("no_id", "id", "k1", "k2", "line_no").alias("at"))
    keys = spark.createDataFrame([(i, 10, len(t), 7) for i, t in enumerate(texts)], "h1 long, h2 long, length int, key long")
    root = {bytes(r["node"]): r["root"] for r in lines.line_groups(found, keys, rows, 0.8).collect()}
    groups = defaultdict(set)
    for node, r in root.items():
        groups[bytes(r)].add(int.from_bytes(node[:8]))
    assert sorted(map(sorted, groups.values())) == [[1, 2, 3], [4, 5]]


def test_lines_are_linked_by_any_key_however_many_are_rarer(spark):
    """Two like lines share their commonest key only, and each has 20 rarer ones that it shares with unlike lines."""
    texts = ["a" * 100, "a" * 95 + "b" * 5, *(c * 100 for c in "cdefghijkl")]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = docs.withColumn("no_id", F.lit(False)).withColumn("k1", F.col("id")).withColumn("k2", F.col("id"))
    places = [(i, 10, False, i, i, i, 0) for i in range(len(texts))]
    found = spark.createDataFrame(places, "h1 long, h2 long, no_id boolean, id long, k1 long, k2 long, line_no int")
    found = found.select("h1", "h2", F.struct("no_id", "id", "k1", "k2", "line_no").alias("at"))
    held = [(i, 7) for i in range(len(texts))] + [(i, 100 * (i + 1) + k) for i in (0, 1) for k in range(20)]
    held += [(2 + k % 10, 100 * (i + 1) + k) for i in (0, 1) for k in range(20)]
    keys = spark.createDataFrame([(i, 10, 100, k) for i, k in held], "h1 long, h2 long, length int, key long")
    root = {int.from_bytes(r["node"][:8]): r["root"] for r in lines.line_groups(found, keys, rows, 0.8).collect()}
    assert set(root) == {0, 1} and root[0] == root[1]


def test_passes_over_the_texts_find_the_same_links(spark, monkeypatch):
    texts = [("a" * 60 + chr(98 + i) * 40, chr(98 + i)) for i in range(4)]
    texts = [t[:k] + "z" * (len(t) - k) for t, _ in texts for k in (100, 95, 70)]
    named = spark.createDataFrame([(bytes([i]), t) for i, t in enumerate(texts)], "name binary, norm string")
    pairs = [(bytes([i]), bytes([k]), 100, 100) for i, k in combinations(range(len(texts)), 2)] * 2
    pairs = spark.createDataFrame(pairs, "a binary, b binary, length_a int, length_b int")
    want = {(i, k) for i, k in combinations(range(len(texts)), 2) if _distance(texts[i], texts[k]) <= 20}
    for share in (100.0, 2.0):
        monkeypatch.setattr(lines, "AT_ONCE", share)
        links = lines._verified(pairs, named, 0.8)
        assert len(links) == (1 if share > 11 else 6)
        assert sorted((r["a"][0], r["b"][0]) for link in links for r in link.df.collect()) == sorted(want)


def test_keys_of_short_and_of_long_lines(spark):
    make = random.Random(9)
    texts = ["one", "so it", "a bc d", "four words stand here", *(" ".join(f"w{make.randrange(500):04}" for _ in range(k)) for k in (19, 24, 30, 33, 41, 300, 3000))]
    df = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "h1 long, h2 long, norm string")
    got = defaultdict(list)
    for r in lines.pair_keys(df).unionByName(lines.block_keys(df)).collect():
        got[r["h1"]].append(r["key"])
    words = spark.createDataFrame([(w,) for t in texts for w in t.split()], "w string").distinct()
    hashes = {r[0]: r[1] & (2**64 - 1) for r in words.select("w", F.xxhash64("w")).collect()}
    for i, t in enumerate(texts):
        want, each = set(), t.split()
        if len(t) < 150:
            some = [w for w in each if len(w) >= 4]
            some = some if len(some) >= 3 else each
            want |= {(some[k - d], some[k]) for d in (1, 2) for k in range(d, len(some))}
        if len(t) >= 120:
            top = 1 << (len(t) // 15).bit_length() - 1
            for b in (top, top // 2) if len(t) / 15 < 1.25 * top else (top,):
                for c in range(min(b, 32)):
                    some = [hashes[w] for w in set(each) if len(w) >= 4 and hashes[w] % b == c]
                    bits = tuple(2 * sum(h >> p + s & 1 for h in some) >= len(some) for p in (8, 9, 10, 11) for s in range(0, 56, 8))
                    want |= {(b, c, bits)} if len(some) >= (2 if b < 32 else 3) else set()
        assert len(got[i]) == len(set(got[i])) == len(want)


def test_each_word_of_a_line_is_in_a_key(spark):
    """Another word in any place changes the keys, also a short one, one alone in its block and one of a block beyond the 32nd."""
    make = random.Random(12)
    word = lambda n: "".join(make.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    short = ["so it", "to be or not to be", "we do so as in it or if on at wonderful little houses"]
    long = [" ".join(word(make.randrange(1, top)) for _ in range(k)) for top, k in ((4, 60), (9, 40), (9, 200), (30, 20), (9, 900))]
    changed = []
    for line, text in enumerate(short + long):
        words = text.split()
        for place in {0, len(words) - 1, *make.choices(range(len(words)), k=25)}:
            changed.append((line, text, " ".join([*words[:place], "qqqqq", *words[place + 1 :]])))
    df = spark.createDataFrame([(i, k, t) for i, c in enumerate(changed) for k, t in enumerate(c[1:])], "h1 long, h2 long, norm string")
    keys = defaultdict(set)
    for r in lines._keys_of(df).collect():
        keys[r["h1"], r["h2"]].add(r["key"])
    assert all(keys[i, 0] != keys[i, 1] for i in range(len(changed)))
    assert all(keys[i, 0] & keys[i, 1] for i, (line, *_) in enumerate(changed) if line >= len(short))


def test_lines_are_linked_by_what_words_of_four_letters_in_32_blocks_leave_out(spark):
    make = random.Random(13)
    word = lambda n: "".join(make.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    # All words of the first 32 of 256 blocks differ, so no block that votes alone is shared.
    pool = spark.createDataFrame([(word(6),) for _ in range(4000)], "w string").select("w", (F.xxhash64("w").bitwiseAND(255) < 32).alias("first")).collect()
    first, others = ([r["w"] for r in pool if r["first"] == kind] for kind in (True, False))
    held = others[:620]
    many = [" ".join(" ".join([*held[10 * i : 10 * i + 10], first[k + i]]) for i in range(62)) for k in (0, 100)]
    typo = lambda t, each: "".join("q" if i % each == each // 2 else c for i, c in enumerate(t))
    run = "".join(make.choices("abcdefghijklmnop", k=400))
    pairs = [
        ("internationalisation", "internationalization"),
        ("cafes", "cafez"),
        ("we do so as in it or if on at wonderful little houses", "we do so as in it or if on at wonderfal littla housas"),
        (run, typo(run, 10)),
        tuple(many),
    ]
    assert all(_distance(a, b) <= 0.2 * max(len(a), len(b)) for a, b in pairs[:-1]) and len(many[0]) >= 256 * 15
    df = spark.createDataFrame([(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in lines.remove_repeated_lines(df).collect()}
    assert got == {i: i % 2 for i in range(2 * len(pairs))}


def test_lines_of_one_length_in_five_less_share_a_number_of_blocks():
    def levels(n):
        top = 1 << (n // lines.BLOCK_CHARS).bit_length() - 1
        return {top, top // 2} if n / lines.BLOCK_CHARS < 1.25 * top else {top}

    assert lines.BLOCKS_FROM <= 0.8 * lines.PAIRED_BELOW
    for n in range(lines.PAIRED_BELOW, 3000):
        assert all(levels(n) & levels(k) for k in range(-(-n * 4 // 5), n + 1))


def test_lines_are_native_and_take_odd_rows(odd_docs, no_docs):
    got = lines.remove_repeated_lines(odd_docs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    rows = {(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in got.collect()}
    assert got.count() == odd_docs.count()
    assert (1, None, 0, 0) in rows and (2, "", 1, 0) in rows and (None, "", 1, 1) in rows
    assert lines.remove_repeated_lines(no_docs).count() == 0


def test_tiles_are_greedy_and_catch_reordering(spark):
    item = [f"t{i}" for i in range(30)]
    texts = {
        "whole": item, "reordered": item[15:] + ["x"] + item[:15], "third": item[:10], "none": ["y"] * 50,
        "scattered": [w for i in range(0, 30, 4) for w in [*item[i : i + 4], "z"]], "twice": item[:14] + item[:14],
    }
    docs = spark.createDataFrame([(k, "so " + " ".join(v).upper() + " it") for k, v in texts.items()], "doc_id string, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, None), (None, "a b c d e f"), (9, "a b")], "item_id long, text string")
    got = {r["doc_id"]: r for r in tiling.decontaminate(docs, bench).collect()}
    assert {k: (round(r["coverage"], 3), r["contaminated"]) for k, r in got.items()} == {
        "whole": (1.0, True), "reordered": (1.0, True), "third": (0.333, False), "none": (0.0, False),
        "scattered": (0.0, False), "twice": (0.467, False),
    }
    assert got["reordered"]["tile_lengths"] == [15, 15] and got["none"]["item"] is None


def test_blocks_of_the_benchmark_change_nothing(spark, docs, texts, odd_docs, no_docs, monkeypatch):
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:12])], "item_id long, text string")
    columns = ["doc_id", "item", "coverage", "tile_starts", "tile_lengths"]
    one = sorted(map(tuple, tiling.decontaminate(docs, bench).select(columns).collect()))
    monkeypatch.setattr(tiling, "BLOCK_BYTES", 1500)
    assert sorted(map(tuple, tiling.decontaminate(docs, bench).select(columns).collect())) == one
    assert tiling.decontaminate(odd_docs, bench).count() == odd_docs.count()
    assert tiling.decontaminate(no_docs, bench).count() == 0
    assert tiling.decontaminate(docs, bench.filter("false")).filter("coverage > 0").count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e-3])
def test_neighbours(spark, scale):
    make = np.random.default_rng(1)
    vectors = make.normal(size=(300, 16)).astype(np.float32) * scale
    vectors[40:140] = vectors[40]  # a hot vector
    vectors[200] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(500, None), (501, [float("nan")] * 16), (None, [1.0] * 16), (502, [1.0, None] * 8), (503, [1.0] * 3), (60, rows[60][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    got = defaultdict(list)
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    good = [i for i in range(300) if i != 200]
    assert set(got) == {i for i in good if i % 20 == 0}
    exact = vectors.astype(np.float64)
    for q, found in got.items():
        scores = {i: float(neighbours.inner_products(exact[q : q + 1], exact[i : i + 1])[0]) for i in good if i != q}
        want = sorted(scores, key=lambda i: (-scores[i], i))[:20]
        assert sorted(found) == [(n, i, scores[i]) for n, i in enumerate(want, 1)]


def test_few_neighbours_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.0]), (20, [3.0])], "vec_id long, embedding array<double>")
    rows = neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect()
    assert [tuple(r) for r in rows] == [(0, 1, 1, 0.5)]
    assert neighbours.nearest(df.filter("false"), F.lit(True)).count() == 0


def test_names_of_columns_do_not_matter(spark):
    """Columns with a dot, a backtick, or the names that the operators use inside come through as they were."""
    text = " ".join(f"word{i}" for i in range(60))
    names = ["a.b", "`a`b", "__c", "__i", "__searched", "__text", "__0", "k0", "text", "doc_id"]
    rows = [(1, 2, 3, 4, 5, 6, 7, 8, text, 9), (11, 12, 13, 14, 15, 16, 17, 18, text, 19)]
    df = spark.createDataFrame(rows, "a long, b long, c long, d long, e long, f long, g long, h long, t string, i long").toDF(*names)
    items = spark.createDataFrame([(10, text), (9, text)], "item_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode_texts(df, path, public_tokenizers.PATTERN)
    for result in (
        repeats.remove_repeats(df),
        tiling.decontaminate(df, items),
        secrets.find_secrets(df),
        encoded,
        bpe.decode_ids(encoded, path),
    ):
        assert result.columns[: len(names)] == names
        got = sorted(tuple(r)[: len(names)] for r in result.collect())
        assert got == rows
    assert {r["item"] for r in tiling.decontaminate(df, items).collect()} == {"9"}  # ids are compared as numbers


def test_spans_of_many_copies_of_a_row_are_gathered_once(spark):
    text = " ".join(f"w{i}" for i in range(120))
    df = spark.range(500).select(F.lit(1).alias("doc_id"), F.lit(text).alias("text"))
    narrow = df.select(*row_key("doc_id", "text"), "text")
    spans = repeats.repeated_windows(narrow).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    assert len(spans.first()["spans"]) <= 120
    assert {r["n_removed"] for r in repeats.remove_repeats(df).collect()} == {120}


def test_groups_above_and_below_a_tile_are_paired(spark, monkeypatch):
    """One key of two large groups and some lines alone; two of these and a line of each large group are like."""
    from gradeline.llm.common import Stored

    monkeypatch.setattr(lines, "TILE", 3)
    names = [bytes([i]) for i in range(16)]
    roots = [0] * 5 + [5] * 6 + list(range(11, 16))
    texts = {i: None for i in range(16)}
    rows = [(7, n, None, True, 40, None, None, None) for n in names]
    columns = "key long, a binary, b binary, possible boolean, length_a int, n_words_a int, words_a array<long>, grams_a array<long>"
    others = spark.createDataFrame(rows, columns)
    groups = spark.createDataFrame([(names[i], names[r]) for i, r in enumerate(roots) if i < 11], "node binary, root binary")
    found, stored = lines._pairs_of_the_rest(others, groups, 0.8)
    got = Counter(tuple(sorted((r["a"][0], r["b"][0]))) for r in found.collect())
    stored.drop()
    assert got == Counter((i, k) for i, k in combinations(texts, 2) if roots[i] != roots[k])


def test_marks_never_rule_out_a_link(spark):
    """Lines with up to a fifth of their characters changed stay possible, and unlike lines mostly do not."""
    make = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz "
    pairs = []
    for _ in range(120):
        a = " ".join("".join(make.choices(letters[:26], k=make.randrange(1, 9))) for _ in range(make.choice((2, 8, 22, 24, 26, 60, 150))))
        b = list(a)
        for _ in range(make.randrange(len(a) // 5 + 1)):
            b[make.randrange(len(b))] = make.choice(letters)
        pairs.append((a, " ".join("".join(b).split())))
    pairs += [(a, b) for (a, _), (b, _) in combinations(pairs, 2) if 0.8 <= len(a) / max(1, len(b)) <= 1.25]
    kinds = sorted({t for pair in pairs for t in pair} - {""})
    place = {t: i for i, t in enumerate(kinds)}
    texts = spark.createDataFrame([(i, 0, t) for i, t in enumerate(kinds)], "h1 long, h2 long, norm string")
    sides = texts.join(lines._marked(texts.unionByName(texts)), ["h1", "h2"], "left").withColumn("length", F.length("norm"))
    assert sides.count() == len(kinds)
    one, two = (sides.select(*[F.col(c).alias(f"{c}_{s}") for c in ("h1", "norm", *lines.WITH_LENGTH)]) for s in "ab")
    pairs = spark.createDataFrame([(place[a], place[b]) for a, b in pairs if a and b], "h1_a long, h1_b long")
    met = pairs.join(one, "h1_a").join(two, "h1_b")
    norm_a, norm_b = F.col("norm_a"), F.col("norm_b")
    like = F.coalesce(lines._share_words(norm_a, norm_b) & lines.edit_similar(norm_a, norm_b, 0.8), F.lit(False))
    plain = F.levenshtein(norm_a, norm_b) <= F.floor(F.greatest("length_a", "length_b") * 0.2 + 1e-9)
    got = met.select(like.alias("like"), (plain & lines._share_words(norm_a, norm_b)).alias("plain"), F.coalesce(lines._possible(0.8), F.lit(False)).alias("possible")).collect()
    assert sum(r["like"] for r in got) > 60
    assert all(r["like"] == r["plain"] for r in got)
    assert all(r["possible"] for r in got if r["like"])
    assert sum(r["possible"] for r in got) < 0.2 * len(got)
