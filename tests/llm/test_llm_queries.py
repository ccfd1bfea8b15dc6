"""The registered queries against SQL, or brute force where SQL has no words for them."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
import xxhash
from oracle import compare, connect

from samplelake.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"
LARGEST = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def rows_of(spark, name, sf=SF):
    return {r["doc_id"]: r.asDict() for r in QUERIES[name](spark, sf).collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, SQL[name]) == ""


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def auc(pairs):
    yes, no = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((a > b) + 0.5 * (a == b) for a in yes for b in no) / (len(yes) * len(no))


def test_toxicity(spark):
    found = rows_of(spark, "op4_toxicity", LARGEST)
    labels = connect(LARGEST).execute("SELECT doc_id, toxic FROM labels").fetchall()
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 for i, r in found.items())
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in found.values())
    assert auc([(found[i]["score"], y) for i, y in labels if held(i)]) > 0.95


def fingerprint(text):
    words = text.encode().lower().split()
    width = min(4, len(words))
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints, radius=4):
    """Smallest doc_id reachable, by comparing all pairs."""
    top = {i: i for i in prints}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {i: root(i) for i in ids}


def test_simhash(spark, texts):
    found = rows_of(spark, "op5_simhash")
    prints = {i: fingerprint(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in found.items()} == linked(prints)


def test_sentencepiece(spark, texts):
    import sentencepiece

    from samplelake.llm.pieces import MODEL

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    found = rows_of(spark, "op6_sentencepiece")
    assert {i: r["ids"] for i, r in found.items()} == {i: library.encode(t) for i, t in texts.items()}
    assert all(r["restored"] and r["n_ids"] == len(r["ids"]) for r in found.values())


def test_language(spark):
    found = rows_of(spark, "op7_language", LARGER)
    langs = dict(connect(LARGER).execute("SELECT doc_id, lang FROM documents").fetchall())
    assert all(r["held_out"] == held(i) and 0 <= r["score"] <= 1 for i, r in found.items())
    out = [found[i]["lang_pred"] == lang for i, lang in langs.items() if held(i)]
    assert sum(out) >= 0.97 * len(out)


def test_sharding(spark, texts):
    found = rows_of(spark, "op8_sharding")
    assert set(found) == set(texts)
    groups, sizes, slots = defaultdict(set), defaultdict(int), defaultdict(list)
    for i, r in found.items():
        body = texts[i].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(body) + 1, zlib.crc32(body), "bytes")
        groups[texts[i]].add(r["shard"])
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(g) == 1 for g in groups.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 1.35 * sum(sizes.values()) / 8


KINDS = ("assign", "access", "hex", "markov")


def base_secrets(text):
    assign = r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])" \
        r"|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']? *[:=] *[\"']?([A-Za-z0-9+/_.=-]+)"
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    return sorted(out)


def told(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_secrets(spark):
    found = rows_of(spark, "op10_secrets", LARGER)
    texts = dict(connect(LARGER).execute("SELECT doc_id, text FROM documents").fetchall())
    for i, text in texts.items():
        spans = base_secrets(text)
        r = found[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert r["base_sha256"] == hashlib.sha256(told(spans).encode()).hexdigest()
        assert ",".join(s for s in r["spans"].split(",") if not s.startswith("markov")) == told(spans)
    assert sum(r["n_assign"] for r in found.values()) > 0


def test_secrets_sql_by_place(spark, tmp_path):
    """An assigned key that stands bare again later, held against the SQL."""
    import duckdb

    key = "Zx9Kq2Lw8Vn4Tb7Rm1Yc"
    rows = [(1, f"password: {key} and later {key} again"), (2, f"{key} before token={key}"), (3, "plain words"), (4, None)]
    rows += [(10 + i, f"the report_of_{w}_and_numbers is ready") for i, w in enumerate(("spring", "summer", "autumn"))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(QUERIES["op10_secrets"](spark, str(tmp_path)), con, SQL["op10_secrets"]) == ""


def test_pipeline(spark, texts):
    import corpus_pipeline
    import sentencepiece

    from samplelake.llm.common import table
    from samplelake.llm.decontaminate import words_of
    from samplelake.llm.pieces import MODEL
    from samplelake.staging import stage

    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, SF), name)
        kept[name] = docs
        assert name == "sentencepiece" or docs.columns == columns
    of = {n: {r["doc_id"]: r["text"] for r in d.collect()} for n, d in kept.items() if n != "sentencepiece"}
    assert len(of["language_id"]) >= 0.98 * len(texts)
    prints = {i: fingerprint(t) for i, t in of["language_id"].items()}
    groups = linked(prints)
    assert set(of["near_dedup"]) == {i for i, g in groups.items() if i == g}
    items = [words_of(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    windows = {tuple(w[k : k + min(10, len(w))]) for w in items for k in range(max(1, len(w) - 9)) if w}
    hit = set()
    for i, t in of["near_dedup"].items():
        w = words_of(t)
        if any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w))):
            hit.add(i)
    assert set(of["decontamination"]) == set(of["near_dedup"]) - hit
    assert set(of["secret_scan"]) == set(of["decontamination"])
    for i, t in of["secret_scan"].items():
        assert not base_secrets(t)
        if not base_secrets(texts[i]):
            assert t == texts[i]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = {r["doc_id"]: r["ids"] for r in kept["sentencepiece"].collect()}
    assert ids == {i: library.encode(t) for i, t in of["secret_scan"].items()}
