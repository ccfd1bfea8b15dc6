"""Line dedup, Merkle manifests and spelling variants against brute force, with odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from samplelake.llm import lines, merkle, spelling
from samplelake.llm.common import take

SCHEMA = "score double, doc_id long, TEXT string, text string, lang string, tree string, source string, n_chars long, t int"


def docs_of(spark, rows):
    """Documents ``id, text, source`` among columns whose names clash with wanted and made ones."""
    full = [(0.5, i, "other", t, "en", "x", s, None if t is None else len(t), 1) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


SHARED = "a line that many documents share"
LONG = "\n".join(f"line number {k} of a long text" for k in range(30_000))
ODD = [
    (3, f"own words of three\n  {SHARED.upper()}\t\nshort\n{SHARED}", "a"),
    (1, f"{SHARED}\nshort\n{SHARED}\n", "a"),
    (1, f"{SHARED}\nshort\n{SHARED}\n", "a"),
    (None, f"{SHARED}\nwith more", "b"),
    (None, "only documents without ids\nhold this line", None),
    (None, "only documents without ids", None),
    (5, None, None),
    (6, "", "a"),
    (7, "\n\n \t\n", "é"),
    (8, "ÀÉ über naïve × ÷ 日本語 über", "é"),
    (9, LONG, "b"),
    (10, LONG + "\nand one line more", "b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD)


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


# line dedup


def kept_lines(rows, least_documents=2):
    """What each row keeps, by brute force."""
    spaces = " \t\n\x0b\f\r"
    upper = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    holders = defaultdict(set)
    split = [(i, [(x, x.strip(spaces).translate(upper)) for x in (t or "").split("\n")]) for i, t, *_ in rows]
    for i, found in split:
        for _, key in found:
            if len(key) >= 10:
                holders[key].add((i is None, i))
    out = []
    for i, found in split:
        me = (i is None, i)
        out.append([x for x, k in found if len(holders[k]) < least_documents or me == min(holders[k], key=lambda h: (h[0], h[1] or 0))])
    return [(i, len(found), len(found) - len(kept), "\n".join(kept)) for (i, found), kept in zip(split, out)]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_line_dedup_of_odd_rows(odd):
    wanted = Counter((i, n, d, digest(t)) for i, n, d, t in kept_lines(ODD))
    assert rows_of(lines.line_dedup(odd)) == wanted
    kept = lines.without_shared_lines(odd)
    assert kept.columns == odd.columns
    texts = Counter((i, None if old is None else t) for (i, old, _), (_, _, _, t) in zip(ODD, kept_lines(ODD)))
    assert Counter((r["doc_id"], r[3]) for r in kept.collect()) == texts
    assert lines.line_dedup(odd.filter("false")).count() == 0


@pytest.mark.parametrize("least, hot_share", [(2, 10_000), (2, 0), (3, 3)])
def test_line_dedup_by_random_lines(spark, least, hot_share):
    """One line in a third of all documents; with and without hashes looked up by broadcast."""
    draw = random.Random(1)
    common = [f"common line {k} of the corpus" for k in range(30)]
    rows = []
    for i in range(300):
        found = [draw.choice(common).replace("common", draw.choice(["common", "Common", "\tCOMMON"])) for _ in range(draw.randint(0, 6))]
        found += [f"own line {draw.randint(0, 500)}", ""] + ["the hot line of all"] * (i % 3 == 0)
        draw.shuffle(found)
        rows.append((i, "\n".join(found), "a"))
    named = take(docs_of(spark, rows), doc_id="doc_id", text="text")
    found = rows_of(lines.marked(named, least, 10, hot_share).select("doc_id", "n_lines", "n_dropped", "kept"))
    assert found == Counter(kept_lines(rows, least))


# Merkle manifest


def joined(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(i, source, lang, n_chars, text):
    values = [None if v is None else str(v) for v in (i, source, lang, n_chars, text)]
    return joined(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def proof_of(nodes, at):
    """Top of a tree and, level by level, what stands left and right of a node."""
    around = []
    while len(nodes) > 1:
        run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
        around.append((run[: at % 3], run[at % 3 + 1 :]))
        nodes, at = [joined(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)], at // 3
    return nodes[0], around


def manifest(rows):
    """The rows of the query by brute force; ``rows`` has ``id, source, lang, n_chars, text``."""
    groups = defaultdict(list)
    for r in rows:
        groups[b"" if r[1] is None else b"=" + r[1].encode()].append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    names = sorted(groups)
    tops = [proof_of([leaf(*r) for r in groups[g]], 0)[0] for g in names]
    out = Counter()
    for place, g in enumerate(names):
        leaves = [leaf(*r) for r in groups[g]]
        for k, r in enumerate(groups[g]):
            top, around = proof_of(leaves, k)
            root, above = proof_of(tops, place)
            changed = r[4]
            if changed is not None and zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 2 == 0:
                changed = changed.replace("\n", "")
            at = leaf(*r[:4], changed)
            for left, right in around + above:
                at = joined(*left, at, *right)
            proof = joined(*(x for left, right in around + above for x in left + right))
            out[r[0], leaves[k], top, root, proof, at, at == root] += 1
    return out


def test_manifest_of_odd_rows(odd):
    rows = [(i, s, "en", None if t is None else len(t), t) for i, t, s in ODD]
    found = rows_of(merkle.merkle_manifest(odd))
    assert found == manifest(rows)
    assert {r[6] for r in found} == {True, False}
    assert merkle.merkle_manifest(odd.filter("false")).count() == 0
    one = [r for r in rows if r[0] == 8]
    assert rows_of(merkle.merkle_manifest(odd.filter("doc_id = 8"))) == manifest(one)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_of_many_blocks(spark, levels):
    """Trees of up to 400 leaves in blocks of 3 and 9 nodes, one source with most rows, lone leaves, many sources."""
    draw = random.Random(levels)
    names = ["hot"] * 400 + ["mid"] * 28 + ["nine"] * 9 + ["ten"] * 10 + [f"s{k}" for k in range(11)] + [None] * 4
    ids = draw.sample(range(-500, 5000), len(names))
    texts = [(i, "\n".join("abc"[: draw.randint(0, 3)] for _ in range(3)), s) for i, s in zip(ids, names)]
    texts += [(9999, "same\nrow", "mid")] * 3
    found = merkle.merkle_manifest(docs_of(spark, texts).repartition(7), levels)
    assert rows_of(found) == manifest([(i, s, "en", len(t), t) for i, t, s in texts])


def test_manifest_of_sources(odd):
    tree = merkle.build(odd)
    found = {r["source"]: (r["n_rows"], r["subroot"]) for r in tree.sources().collect()}
    rows = [(i, s, "en", None if t is None else len(t), t) for i, t, s in ODD]
    subroots = {leaf_: top for _, leaf_, top, *_ in manifest(rows)}
    assert found == {
        s: (n, next(subroots[leaf(*r)] for r in rows if r[1] == s)) for s, n in Counter(r[1] for r in rows).items()
    }


# spelling variants


def edited(a, b):
    """True where exactly one character is inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def by_brute_force(counts):
    near = {w: [v for v in counts if edited(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def words_of(rows):
    counts, upper = Counter(), {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += len(run) >= 5
    return {w: n for w, n in counts.items() if n >= 3}


@pytest.mark.parametrize("letters, longest", [("ab", 9), ("abcdé", 7), ("aÀ÷", 12)])
def test_scan_of_sorted_words(letters, longest):
    draw = random.Random(longest)
    for size in range(60):
        words = sorted({"".join(draw.choices(letters, k=draw.randint(0, longest))) for _ in range(size)})
        wanted = {(i, j) for j in range(len(words)) for i in range(j) if edited(words[i], words[j])}
        found = list(spelling.one_edit_apart(words))
        assert len(found) == len(set(found)) and set(found) == wanted


@pytest.mark.parametrize("most", [20_000, 12, 3])
def test_variants_by_random_words(spark, most):
    """Words that share long beginnings and ends, so that small buckets must be dealt anew, many times over."""
    draw = random.Random(most)
    stems = ["anti" + "".join(draw.choices("abc", k=draw.randint(1, 8))) + draw.choice(["ation", "", "s"]) for _ in range(150)]
    stems += ["".join(draw.choices("ab", k=draw.randint(5, 7))) for _ in range(100)] + ["aaaaaaaaaaaa" + "ab"[k % 2] * k for k in range(9)]
    counts = {w: draw.choice([3, 4, 7, 15, 40]) for w in stems}
    df = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string")
    assert {tuple(r) for r in spelling.variants(df, most=most).collect()} == by_brute_force(counts)


def test_chains_of_forms(spark):
    """Each word twice as common as the one before it."""
    chain = ["abcdefghij", "abcdefghiX", "abcdefghYX", "abcdefgZYX", "abcdefWZYX", "abcdeVWZYX"]
    counts = {w.lower(): 3 * 2**k for k, w in enumerate(chain)}
    df = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string")
    found = {tuple(r) for r in spelling.variants(df).collect()}
    assert found == by_brute_force(counts)
    assert {r[2] for r in found} == {chain[-1].lower()}


def test_variants_of_odd_rows(spark, odd):
    rows = [(i, t) for i, t, _ in ODD]
    long = "x" * 20_000
    more = [(20 + k, f"{long} {long}y z{long} Naïve naïve naive NAIVE") for k in range(4)]
    df = take(odd, doc_id="doc_id", text="text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    assert {tuple(r) for r in spelling.spelling_variants(df).collect()} == by_brute_force(words_of(rows + more))
    assert spelling.spelling_variants(odd.filter("false")).count() == 0
    assert spelling.spelling_variants(odd).columns == ["word", "form", "root", "n", "n_near", "form_n"]
