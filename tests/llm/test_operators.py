"""Small cases of each operator: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from samplelake.llm import (
    decontaminate,
    language,
    licenses,
    pieces,
    quality,
    secrets,
    sharding,
    simhash,
    toxicity,
    urls,
)
from samplelake.llm.common import held_out, take

LONG = "lorem ipsum dolor sit amet " * 8000
SCHEMA = "score double, doc_id long, TEXT string, text string, lang string, fp string, row int, n_chars long, hits int"


def docs_of(spark, rows):
    """Documents among columns whose names clash with wanted and made ones."""
    full = [(0.5, i, "other", t, lang, "x", 7, None if t is None else len(t), 1) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, None, None),
    (2, "", "en"),
    (3, " \n\t ", "en"),
    (4, "one two three four five six seven eight nine ten eleven twelve", "en"),
    (4, "one two three four five six seven eight nine ten eleven twelve", "en"),
    (None, "one two three four five six seven eight nine ten eleven twelve", None),
    (6, "日本語 ünï 😀 \x00 ", "xx"),
    (7, LONG, "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, ODD).filter("false")


def test_take_by_exact_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, A int, b int").toDF("a", "A", "a")
    assert [tuple(r) for r in take(df, x="A", y="a").collect()] == [(2, 1)]


def test_held_out_of_null(spark):
    df = spark.createDataFrame([(None,), (5,)], "i long").select(held_out(take_col("i")))
    assert [r[0] for r in df.collect()] == [True, zlib.crc32(b"5") % 5 == 0]


def take_col(name):
    from pyspark.sql import functions as F

    return F.col(name)


# decontamination


def benchmark_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, n_hit int")


def test_leaks_of_odd_rows(spark, odd, none):
    items = benchmark_of(spark, [
        (1, "Two THREE four, five-six seven eight nine ten eleven", 0),  # one window
        (2, "nine ten", 0),  # shorter than a window
        (3, None, 0), (4, "", 0), (None, "eleven twelve", 0), (2, "nine ten", 0), (5, "absent words", 0),
    ])
    found = {(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.leaks(odd, items).collect()}
    assert (4, 12, 11, 2, True) in found and (None, 12, 11, 2, True) in found
    assert (1, 0, 0, 0, False) in found and (7, 40000, 0, 0, False) in found
    assert decontaminate.leaks(odd, items).count() == len(ODD)
    assert decontaminate.leaks(none, items).count() == 0
    assert {r["n_hit"] for r in decontaminate.leaks(odd, items.filter("false")).collect()} == {0}


def test_leaks_in_blocks(spark, odd):
    items = benchmark_of(spark, [(k, t, 0) for k, t in enumerate(["one two", "two three", "lorem ipsum dolor", "x"])])
    whole = decontaminate.find_leaks(take(odd, text="text"), items, drop=("text",))
    cut = decontaminate.find_leaks(take(odd, text="text"), items, block_bytes=1, drop=("text",))
    for column in ("n_words", "n_hit", "items_sha256"):
        assert sorted(r[column] for r in whole.collect()) == sorted(r[column] for r in cut.collect())


def test_rows_are_held_up_to_a_size():
    batches = [pa.record_batch({"t": pa.array(["x" * n])}) for n in (10, 200, 10, 10, 500)]
    held = list(decontaminate.portions(iter(batches), 150))
    assert [len(h) for h in held] == [2, 3] and [b for h in held for b in h] == batches
    assert [len(h) for h in decontaminate.portions(iter(batches), 0)] == [1] * 5


def test_search_finds_all():
    draw = random.Random(1)
    for _ in range(300):
        words = [draw.choice("abc") for _ in range(draw.randint(0, 40))]
        items = [(str(k), [draw.choice("abc") for _ in range(draw.randint(0, 9))]) for k in range(4)]
        tables = decontaminate.compile_windows(items, window=4)
        expected = set()
        for name, item in items:
            size = min(4, len(item))
            for at in range(len(item) - size + 1 if size else 0):
                for k in range(len(words) - size + 1):
                    if words[k : k + size] == item[at : at + size]:
                        expected.add((k, k + size, name))
        found = {(a, b, name) for a, b, names in decontaminate.search(words, tables) for name in names}
        assert found == expected
        spans = np.array([[a, b] for a, b, _ in found] or np.empty((0, 2), int))
        assert decontaminate.covered(spans) == len({p for a, b, _ in found for p in range(a, b)})


# urls


def test_urls(spark):
    rules = urls.rules_table(spark, (
        ("block", "net", "/"), ("allow", "Example.net", "/en/"), ("block", "a.example.net", ""), ("allow", "a.example.net", ""),
    )).unionByName(spark.createDataFrame([("block", None, "/")], "verdict string, host string, path string"))
    rows = [
        ("https://x.EXAMPLE.net/en/1?q#f", "x.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("http://example.net", "example.net", "", None, "allow"),
        ("http://b.a.example.net/en/", "b.a.example.net", "/en/", "example.net/en/", "allow"),
        ("http://a.example.net", "a.example.net", "", "a.example.net", "allow"),
        ("http://anet/x", "anet", "/x", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://?x://y", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(k % 9, "h", u) for k, (u, *_) in enumerate(rows)], "page_id long, host string, url string")
    found = urls.judged(pages, rules).collect()
    assert sorted(map(repr, (tuple(r)[1:] for r in found))) == sorted(repr(tuple(r[1:])) for r in rows)
    assert urls.judged(pages.filter("false"), rules).count() == 0
    assert {r["verdict"] for r in urls.judged(pages, rules.filter("false")).collect()} == {"allow"}


def test_urls_across_ranges(spark):
    """One hot host over many ranges keeps its rules in each."""
    pages = spark.range(3000).selectExpr("id AS page_id", "'http://h.example.net/en/' || id AS url")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = urls.judged(pages, urls.rules_table(spark)).groupBy("rule").count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert [tuple(r) for r in found] == [("example.net/en/", 3000)]


# licences


def test_licenses(spark, none):
    notice = "Released under the MIT License."
    rows = [
        (1, None, None), (2, "", None), (3, notice, None), (3, notice, None), (None, f"x\n{notice}\n{notice}", None),
        (5, "RELEASED under the mit Licence!!\n(c) Copyright 2020 Someone", None), (6, "a licence of my own", None),
        (7, LONG + "\nLicensed under CC BY-NC 4.0.", None),
    ]
    found = licenses.licensed(docs_of(spark, rows), licenses.known_licenses(spark))
    told = sorted((repr(r["doc_id"]), r["n_matches"], r["licenses"], r["whole"]) for r in found.collect())
    assert told == sorted([
        ("1", 0, "", False), ("2", 0, "", False), ("3", 1, "MIT", True), ("3", 1, "MIT", True), ("None", 1, "MIT", False),
        ("5", 2, "MIT", True), ("6", 0, "", False), ("7", 1, "CC-BY-NC-4.0", False),
    ])
    assert licenses.licensed(none, licenses.known_licenses(spark)).count() == 0


def test_known_forms_have_anchors(spark):
    import re

    assert all(re.search(licenses.ANCHOR, text) for _, _, text in licenses.KNOWN)


# toxicity


def edits(a, b):
    """Edit distance with swaps of neighbours."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_trie_finds_what_distance_says():
    draw = random.Random(2)
    terms = {"".join(draw.choice("abc") for _ in range(draw.randint(3, 8))): 1.0 for _ in range(40)}
    trie = toxicity.Trie(terms)
    for _ in range(3000):
        word = "".join(draw.choice("abc") for _ in range(draw.randint(1, 9)))
        near = {t for t in terms if len(word) >= 5 and len(t) >= 4 and edits(word, t) == 1}
        expected = (word, 0) if word in terms else (min(near), 1) if near else None
        assert trie.find(word) == expected


def test_quoted_terms_count_elsewhere():
    trie = toxicity.Trie({"idiot": 2.0})
    plain = toxicity.features("You idiot there", trie)
    quoted = toxicity.features('They wrote "you idiot" there', trie)
    misspelled = toxicity.features("You idoit there", trie)
    assert plain[1] > 0 and plain[3] == 0 and quoted[1] == 0 and quoted[3] > 0 and misspelled[2] > 0
    assert toxicity.features(None, trie) == toxicity.features("", trie) == [1.0, 0.0, 0.0, 0.0, 0.0]


def test_signs_and_digits_inside_words():
    trie = toxicity.Trie({"idiot": 2.0, "trash": 2.0, "moron": 2.0})
    found = trie.hits("an id1ot of tra$h, m*ron! but idiot5 and 5moron, x9 ab1cd2ef idiot3trash")
    assert [(h[0], h[3], h[4]) for h in found] == [
        (1, "idiot", 1), (3, "trash", 1), (4, "moron", 1), (6, "idiot", 0), (8, "moron", 0),
        (13, "idiot", 0), (14, "trash", 0)]
    assert trie.hits("x9 ab1cd2ef") == []


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (2, 0), (7, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.toxicities(odd, labels).collect()
    assert len(found) == len(ODD) and all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.toxicities(none, labels).count() == 0
    assert {r["score"] for r in toxicity.toxicities(odd, labels.filter("false")).collect()} == {0.0}


# simhash


def test_covering_misses_no_pair():
    draw = random.Random(3)
    masks = simhash.covering_masks()
    for first in (masks, simhash.second_masks(masks[5])):
        for _ in range(3000):
            bits = draw.sample([b for b in range(64) if first is masks or not masks[5] >> b & 1], draw.randint(0, 4))
            assert any(not sum(1 << b for b in bits) & m for m in first)


@pytest.mark.parametrize("hot", [20_000, 10])
def test_links_of_crowded_fingerprints(spark, hot):
    """A crowd of near fingerprints, with every bucket dealt anew at the smaller limit."""
    draw = random.Random(4)
    centres = [draw.getrandbits(64) for _ in range(4)]
    prints = list({c ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for c in centres for _ in range(150)})
    values = np.array(prints, np.uint64)
    df = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "fp long")
    names = dict(zip(prints, simhash.vertex_names(values).tolist()))
    roots = {r["v"]: r["root"] for r in simhash.components(simhash.links(df, hot_bucket=hot)).collect()}
    found, expected = {}, {}
    for p in prints:
        found.setdefault(roots.get(names[p], names[p]), set()).add(p)
    left = set(prints)
    while left:
        open_ = [left.pop()]
        group = set(open_)
        while open_:
            x = open_.pop()
            near = {y for y in left if (x ^ y).bit_count() <= 4}
            left -= near
            group |= near
            open_ += near
        expected[min(group)] = group
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_components_of_a_chain(spark):
    names = list(range(400))
    random.Random(5).shuffle(names)
    df = spark.createDataFrame([tuple(sorted(p)) for p in zip(names, names[1:])], "a long, b long")
    assert {tuple(r) for r in simhash.components(df).collect()} == {(v, 0) for v in range(1, 400)}
    assert simhash.components(df.filter("false")).count() == 0


def test_simhash_of_odd_rows(odd, none):
    found = {(r["doc_id"], r["fingerprint"] == "0" * 16, r["component_id"]) for r in simhash.near_duplicates(odd).collect()}
    assert {(1, True, 1), (2, True, 1), (3, True, 1), (4, False, 4), (None, False, 4)} <= found
    assert simhash.near_duplicates(odd).count() == len(ODD)
    assert simhash.near_duplicates(none).count() == 0


def test_one_of_each_group(odd, none):
    kept = simhash.one_of_each_group(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 6, 7]
    assert simhash.one_of_each_group(none).count() == 0


def test_one_of_each_group_shuffles_no_text(spark):
    """Rows are chosen in place, also where the chosen ones are too many for a broadcast by size."""
    texts = [f"{i // 2} " * 3 + " ".join(f"w{(i // 2) * k % 97}" for k in range(1, 30)) for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "-1")
        kept = simhash.one_of_each_group(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        groups = simhash.near_duplicates(docs).collect()
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in groups})
    finally:
        for n, value in before.items():
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_staged_tables_go_with_their_scope(spark, odd):
    from pathlib import Path

    from samplelake import staging

    folder = Path(staging.staging_path(spark, "x").removeprefix("file:")).parent

    def staged():
        return {p.name for p in folder.iterdir()} if folder.exists() else set()

    before = staged()
    kept = simhash.one_of_each_group(odd)
    assert sorted(n.rsplit("-", 1)[0] for n in staged() - before) == ["kept", "rows"]
    assert kept.count() == 4


# sentencepiece


def test_pieces_as_the_library():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    model = pieces.read_model()
    draw = random.Random(6)
    vocabulary = [p.replace(pieces.MARK, " ") for p in model.ids]
    texts = ["", " ", "   a  b   ", " " * 50, "\n\ta\n", "a" * 300, "日本 😀", "<s> <0x41>", "▁x ▁▁", "\x00", "=" * 40]
    texts += ["".join(draw.choice("abcdeionrst ▁.,;\n0é日=-") for _ in range(draw.randint(1, 60))) for _ in range(2000)]
    texts += ["".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 12))) for _ in range(2000)]
    ids = pieces.Encoder(model).encode(texts)
    assert ids == [library.encode(t) for t in texts]
    added = pieces.bytes_of(model)
    assert [pieces.decode(i, added) for i in ids] == [t.replace(pieces.MARK, " ") for t in texts]


def test_pieces_of_many_words_in_arrays(monkeypatch):
    """Thousands of short words are walked by the length of their prefixes, not word by word."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    model = pieces.read_model()
    draw = random.Random(13)
    syllables = ["an", "the", "é", "ou", "ing", "b", "St", "o", "qu", "日", "7", "-", "x,"]
    words = ["".join(draw.choice(syllables) for _ in range(draw.randint(1, 6))) for _ in range(20_000)]
    long = "".join(draw.choice("abcdefgh") for _ in range(3000))
    texts = [" ".join(words[i : i + 50]) for i in range(0, len(words), 50)] + [long, long + "ab c", "😀" + long]
    walked = []
    by_word = pieces.Encoder.states
    monkeypatch.setattr(pieces.Encoder, "states", lambda self, word, *rest: walked.append(word) or by_word(self, word, *rest))
    assert pieces.Encoder(model).encode(texts) == [library.encode(t) for t in texts]
    assert len(set(walked)) < 100


def test_pieces_in_arrays_and_by_word(monkeypatch):
    model = pieces.read_model()
    draw = random.Random(14)
    texts = ["".join(chr(draw.choice([*range(1, 400), 32, 32, 9601, 26085, 128512])) for _ in range(60)) for _ in range(300)]
    texts += ["", "a   b", " " * 20, "▁" * 20 + "a  ", "", "  \n  "]
    added = pieces.bytes_of(model)
    ids, places = pieces.Encoder(model).encode_flat(texts)
    in_arrays = [ids[a:b].tolist() for a, b in zip(places, places[1:])]
    back = list(pieces.texts_of(ids, places, pa.array(added, pa.large_binary())))
    assert back == [pieces.decode(i, added) for i in in_arrays] == [t.replace(pieces.MARK, " ") for t in texts]
    monkeypatch.setattr(pieces, "FEW", 1_000_000)
    monkeypatch.setattr(pieces, "REMEMBERED", 100)
    by_word = pieces.Encoder(model)
    assert in_arrays == [by_word.encode([t])[0] for t in texts]


def test_pairs_of_pieces_in_arrays():
    encoder = pieces.Encoder(pieces.read_model())
    draw = random.Random(15)
    usable = [i for i in encoder.model.ids.values() if encoder.model.lengths[i] == 1 or i in encoder.model.parts]
    left, right = (np.array([draw.choice(usable) for _ in range(5000)]) for _ in range(2))
    # Two halves of a piece are torn by its merge; such pairs are rare among drawn ones.
    halves = list(encoder.model.parts.values())[:5000]
    left, right = (np.concatenate([x, [h[k] for h in halves]]) for k, x in enumerate((left, right)))
    wanted = [encoder.stays_apart(a, b) for a, b in zip(left.tolist(), right.tolist())]
    assert len(set(wanted)) == 2
    for _ in range(2):  # the second time from memory
        assert encoder._stay_apart(left, right).tolist() == wanted


def test_pieces_of_odd_rows(odd, none):
    found = [tuple(r) for r in pieces.document_ids(odd).collect()]
    assert (1, 0, None, None) in found and (2, 0, [], True) in found and len(found) == len(ODD)
    assert all(r[3] for r in found if r[2] is not None)
    assert pieces.document_ids(none).count() == 0
    back = pieces.decoded(pieces.document_ids(odd))
    assert {r["decoded"] for r in back.collect()} == {t for _, t, _ in ODD}


# language


def test_language_of_odd_rows(odd, none):
    found = [tuple(r) for r in language.languages(odd).select("doc_id", "lang_pred", "score").collect()]
    assert len(found) == len(ODD)
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)} <= set(found)
    assert all(0 <= r[2] <= 1 for r in found)
    assert language.languages(none).count() == 0
    assert language.with_language(odd).columns == odd.columns


def test_language_without_labels(spark):
    docs = docs_of(spark, [(k, "some words here", None) for k in range(5)])
    assert {r["lang_pred"] for r in language.languages(docs).collect()} == {"und"}


# sharding


def best_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, left = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > left:
                used, left = used + 1, middle
            left -= s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


def test_capacity_is_the_smallest(spark):
    draw = random.Random(7)
    sizes = [draw.randint(1, 400) for _ in range(60)]
    groups = spark.createDataFrame([(f"{k:03d}", s) for k, s in enumerate(sizes)], "key string, bytes long")
    upto = sharding.summed(groups)
    ends = sharding.smallest_capacity(upto, sum(sizes), max(sizes), 5)
    assert ends[-1] == sum(sizes)
    assert max(b - a for a, b in zip([0, *ends], ends)) == best_capacity(sizes, 5)


def test_a_hot_group_stands_alone(spark, none):
    rows = [(k, "copy " * 50, None) for k in range(60)] + [(100 + k, f"text {k} " * 9, None) for k in range(80)]
    rows += [(500, None, None), (501, "", None), (None, "", None)]
    found = sharding.sharded(docs_of(spark, rows)).collect()
    assert len(found) == len(rows)
    hot = {r["shard"] for r in found if r["doc_id"] is not None and r["doc_id"] < 60}
    assert hot == {0} and all(r["doc_id"] < 60 for r in found if r["shard"] == 0)
    sizes = {}
    for r in found:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    rest = [n for s, n in sizes.items() if s]
    assert len(rest) == 7 and max(rest) - min(rest) < 200
    assert [r["size"] for r in found if r["doc_id"] == 500] == [1]
    assert sharding.sharded(none).count() == 0


# quality


def test_quality_of_odd_rows(odd, none):
    found = {r["doc_id"]: r for r in quality.judged(odd).collect()}
    assert found[1]["n_words"] == found[2]["n_words"] == found[3]["n_words"] == 0 and found[1]["base_failed"]
    assert found[7]["n_words"] == found[7]["n_repeat_words"] == 40000 and found[7]["base_failed"]
    assert quality.judged(odd).count() == len(ODD) and quality.judged(none).count() == 0


def test_repeated_words(spark):
    draw = random.Random(8)
    texts = [" ".join(draw.choice("abcd") for _ in range(draw.randint(0, 30))) for _ in range(200)]
    rows = quality.counts(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).collect()
    for r in rows:
        w = r["text"].split()
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        places = {p for k, x in enumerate(windows) if windows.count(x) > 1 for p in range(k, k + 3)}
        assert r["n_repeat_words"] == len(places)


# secrets


def test_secrets_of_odd_rows(spark, odd, none):
    key = "AKIA" + "A1B2C3D4" * 2
    rows = [
        (1, f"é {key} é", None), (2, "token = password: abcdefghijkl", None), (3, "API_KEY='abcdefghijkl.+/'", None),
        (4, "pASSwd:short", None), (5, "deadbeef" * 2 + "X" + "0" * 15, None), (6, (key + " ") * 700, None),
    ]
    found = {r["doc_id"]: r for r in secrets.secret_spans(docs_of(spark, rows)).collect()}
    assert found[1]["spans"] == "access:2:22" and found[2]["spans"] == "" and found[4]["spans"] == ""
    assert found[3]["spans"] == "assign:0:24" and found[5]["spans"].split(",")[0] == "hex:0:16"
    assert found[6]["spans"].split(",")[::350] == ["access:0:20", "access:7350:7370"]
    assert secrets.secret_spans(odd).count() == len(ODD) and secrets.secret_spans(none).count() == 0
    clean = secrets.redact(docs_of(spark, rows)).collect()
    by_id = {r["doc_id"]: r for r in clean}
    assert by_id[1]["text"] == "é <secret> é" and by_id[1]["n_chars"] == 12 and by_id[2]["text"] == rows[1][1]
    assert secrets.redact(odd).columns == odd.columns and secrets.redact(none).count() == 0


def test_markov_tells_random_from_ordinary(spark):
    draw = random.Random(9)
    syllables = ["ing", "the", "an", "er", "tion", "ed", "or", "re"]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

    def noise():
        return "".join(draw.choice(letters) for _ in range(32))

    rows = [(k, f"secret: {noise()} and {''.join(draw.choice(syllables) for _ in range(8))} end", None) for k in range(300)]
    lone = noise()
    rows.append((999, f"so {lone} stands alone by theaningeredtionan", None))
    found = {r["doc_id"]: r for r in secrets.secret_spans(docs_of(spark, rows)).collect()}
    assert found[999]["spans"] == "markov:3:35"
    assert sum(r["n_markov"] for r in found.values()) == 1


def test_an_assigned_key_that_stands_bare_again(spark):
    draw = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"

    def noise():
        return "".join(draw.choice(letters) for _ in range(32))

    rows = [(k, f"secret: {noise()} and theaningeredtionanering end", None) for k in range(300)]
    key = noise()
    rows.append((999, f"password: {key} then {key} and {key}", None))
    found = {r["doc_id"]: r for r in secrets.secret_spans(docs_of(spark, rows)).collect()}
    assert found[999]["spans"] == "assign:0:42,markov:48:80,markov:85:117"
    assert sum(r["n_markov"] for r in found.values()) == 2
