"""Language identification by compression with zstandard dictionaries.

Each language has raw-content dictionaries of its own texts.  A text is encoded with
every language's dictionary, and the language whose output is smallest is chosen; where
the two smallest are nearly equal the text is rejected.  Texts are reduced to lower-case
letters first.  Long texts are encoded in pieces, so that the dictionary and not the
text's own past explains them; short ones are repeated, as the format stores very short
blocks as they are, and encoded with several dictionaries a language.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from samplelake.llm.common import extended, held_out, keyed, schema_of, slices, take

# The labelled sample: so many texts a language, so many characters of each, all in one dictionary.
SAMPLE_TEXTS, SAMPLE_CHARS = 1008, 220
# The sample is the first texts of so many hash buckets each, so that no task ranks a whole language.
SAMPLE_BUCKETS = 16
LEVEL = 6
# A text is encoded in pieces; a piece is repeated up to so many bytes, so that sizes of few bytes can differ.
PIECE_BYTES, LEAST_BYTES = 8192, 256
# Share of the second smallest size by which the smallest must lie below it.
LEAST_MARGIN = 0.02
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")

# Per language: its name, its texts in the corpus, its dictionary.
Learned = list[tuple[str, int, bytes]]


def letters(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def learn(docs: DataFrame) -> Learned:
    """Dictionaries from ``text, lang`` of labelled rows, without null or letterless texts.

    The sample is the texts with the smallest hashes of each bucket, each distinct text
    once, so a large group of copies counts as one; it is bounded by the constants above for each
    language, and the only rows that come to the driver.
    """
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", F.xxhash64("text").alias("h"))
    chosen = rows.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.pmod("h", F.lit(SAMPLE_BUCKETS))
    order = F.row_number().over(Window.partitionBy("lang", bucket).orderBy("h"))
    chosen = chosen.withColumn("rank", order).filter(F.col("rank") <= SAMPLE_TEXTS // SAMPLE_BUCKETS)
    chosen = chosen.select("lang", "h", (F.col("rank") * SAMPLE_BUCKETS + bucket).alias("place"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    start = F.pmod("h", F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1))) + 1
    pieces = (
        rows.join(F.broadcast(chosen), ["lang", "h"])
        .groupBy("lang", "place")
        .agg(F.min(F.substring("text", start, F.lit(SAMPLE_CHARS))).alias("piece"))
        .collect()
    )
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in pieces:
        if any(map(str.isalpha, row["piece"])):
            texts.setdefault(row["lang"], []).append((row["place"], letters(row["piece"])))
    learned = []
    for lang, found in sorted(texts.items()):
        ordered = [piece for _, piece in sorted(found)]
        # A dictionary of fewer than 8 bytes is refused by the format's library.
        learned.append((lang, counts[lang], " ".join(ordered).encode().ljust(8)))
    return learned


class Classifier:
    def __init__(self, learned: Learned):
        self.names = [name for name, _, _ in learned]
        self.counts = [count for _, count, _ in learned]
        self.encoders = [_encoder(dictionary) for _, _, dictionary in learned]

    def sizes(self, text: str) -> list[int]:
        """Size of the encoded text for each language."""
        body = letters(text).encode()
        pieces = [body[at : at + PIECE_BYTES] for at in range(0, len(body), PIECE_BYTES)]
        pieces = [(p + b" ") * -(-LEAST_BYTES // (len(p) + 1)) if len(p) < LEAST_BYTES else p for p in pieces]
        return [sum(len(encoder.compress(p)) for p in pieces) for encoder in self.encoders]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin of a whole text; ties go to the language with more texts."""
        if text is None or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        found = sorted(zip(self.sizes(text), (-c for c in self.counts), self.names))
        margin = 1 - found[0][0] / found[1][0] if len(found) > 1 else 1.0
        return found[0][2], 1 - 0.5 * 2 ** (-margin / LEAST_MARGIN), margin


def _encoder(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def judged(docs: DataFrame, learned: Learned, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``lang_pred, score, rejected``.

    A null text, or one without a letter, is ``und`` with score 0 and is rejected; so is
    every text where no language was learned.  Other rejected texts keep the best
    language.  Rows are judged one by one, so repeated rows get equal answers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(shared.value).judge
        for part in slices(batches):
            found = [judge(t.as_py()) for t in part.column(text)]
            columns = {
                "lang_pred": pa.array([x[0] for x in found], pa.string()),
                "score": pa.array([x[1] for x in found], pa.float64()),
                "rejected": pa.array([x[0] == UNKNOWN or x[2] < LEAST_MARGIN for x in found], pa.bool_()),
            }
            yield extended(part, list(drop), columns)

    return docs.mapInArrow(run, schema_of(docs, list(drop), "lang_pred string, score double, rejected boolean"))


def languages(docs: DataFrame) -> DataFrame:
    """Result of the query, one row per document; learned outside the held-out fold."""
    docs = take(docs, doc_id="doc_id", text="text", lang="lang")
    docs = docs.withColumn("held_out", held_out(F.col("doc_id")))
    learned = learn(docs.filter(~F.col("held_out")))
    return judged(docs.drop("lang"), learned, drop=("text",))


def with_language(docs: DataFrame) -> DataFrame:
    """The documents, all columns, that are not rejected."""
    named, back = keyed(docs, doc_id="doc_id", text="text", lang="lang")
    learned = learn(named.filter(~held_out(F.col("doc_id"))))
    return back(judged(named.drop("lang", "doc_id"), learned, drop=("text",)).filter(~F.col("rejected")))
