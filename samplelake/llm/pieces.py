"""SentencePiece encoding and decoding by a forward search over a trie of marked words.

Distinct marked words are sorted, so the words below a node of their trie stand side by
side: a word shares a prefix with the one before it, and the forward states of that
prefix are worked out once for all of them.  The trie is walked level by level, all
prefixes of one length in arrays, and word by word where few words are so long.  A state
is the last piece of the best path to that place.  In a model
of the BPE type, as the given one, the best path to every place is unique: its last
piece is the one that no earlier-ranked merge would have torn apart from the piece
before it, so a state needs its own place and the state where the piece starts, nothing
else.  Ids are those of the public library.

A model is read once on the driver and broadcast as plain tables.
"""

from __future__ import annotations

import os
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from samplelake.llm.common import extended, schema_of, slices, take

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
NORMAL, BYTE = 1, 6
# Words whose ids a task remembers; when full it starts anew.
REMEMBERED = 500_000
# Texts whose words make one trie: the more of them, the longer the prefixes they share.
TRIE_TEXTS = 1024
# Words walked in arrays; below that number the walk goes on word by word.
FEW = 64
# Bits of a slot among the remembered pairs of pieces.
PAIR_BITS = 20
NO_PIECE, BYTES = -1, -2


@dataclass
class Model:
    """The tables of a model: pieces by id, their ranks, and what is needed to join them."""

    pieces: list[str]
    ids: dict[str, int]  # normal pieces
    rank: dict[int, float]  # lower merges first
    bytes_: list[int]  # id of each byte
    lengths: list[int]  # characters of each piece
    longest: int
    parts: dict[int, tuple[int, int]]  # the two pieces that merge to a piece, where they do
    words: re.Pattern  # runs no piece reaches out of: from a mark, or from a sign that never follows letters in a piece
    # The search for pieces that end at a place, as a machine over characters: the node a
    # character leads to, the node to fall back to, the longest piece ending at a node, and
    # the next shorter piece that a piece ends with.
    steps: dict[int, int]
    falls: list[int]
    ending: list[int]
    shorter: list[int]
    arrays: dict[str, np.ndarray]  # the same for walks of many words at once


def read_model(path: str = MODEL) -> Model:
    """Read a BPE model with byte fallback and an identity normaliser; others are refused."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    read = proto.ModelProto()
    with open(path, "rb") as file:
        read.ParseFromString(file.read())
    rules = read.normalizer_spec
    if read.trainer_spec.model_type != 2 or not read.trainer_spec.byte_fallback:
        raise ValueError("a BPE model with byte fallback is needed")
    if rules.precompiled_charsmap or not rules.add_dummy_prefix or rules.remove_extra_whitespaces:
        raise ValueError("the model must not rewrite texts, but for the mark before them")
    pieces = [p.piece for p in read.pieces]
    ids = {p.piece: i for i, p in enumerate(read.pieces) if p.type == NORMAL}
    rank = {i: -read.pieces[i].score for i in ids.values()}
    byte_ids = [read_id for read_id, p in enumerate(read.pieces) if p.type == BYTE]
    parts = {}
    for piece, i in ids.items():
        if len(piece) > 1:
            two = _last_merge(piece, ids, rank)
            if two:
                parts[i] = two
    joined = {c for p in ids if len(p) > 1 for c in p}
    pairs = {pair for p in ids for pair in zip(p, p[1:])}
    if any(b == MARK and a != MARK for a, b in pairs):
        raise ValueError("pieces must hold marks at their start only")
    signs = {c for c in joined if c != MARK and not c.isalnum()}
    while reached := {b for a, b in pairs if b in signs and a not in signs and a != MARK}:
        signs -= reached
    sign = re.escape("".join(sorted(signs)))
    others = re.escape("".join(sorted(joined - signs - {MARK})))
    # A character that no piece of several characters holds stands by itself.
    words = re.compile(f"(?s){MARK}[{sign}]*[{others}]*|[{sign}]+[{others}]*|[{others}]+|.")
    usable = [i for p, i in ids.items() if len(p) == 1 or i in parts]
    lengths = [len(p) for p in pieces]
    machine = _machine(pieces, usable)
    arrays = _arrays(*machine) | _joins(ids, rank) | _spines(len(pieces), rank, parts)
    arrays |= {"lengths": np.array(lengths, np.int64), "bytes": np.array(byte_ids, np.int32)}
    return Model(pieces, ids, rank, byte_ids, lengths, max(map(len, ids)), parts, words, *machine, arrays)


def _step(node: int, character: str) -> int:
    return node << 21 | ord(character)


def _machine(pieces: list[str], usable: list[int]) -> tuple[dict[int, int], list[int], list[int], list[int]]:
    """Aho-Corasick tables of the usable pieces, by breadth; -1 stands for no piece."""
    steps: dict[int, int] = {}
    falls, own, above, by_depth = [0], [-1], [(0, "")], [[0]]
    for i in usable:
        node = 0
        for depth, c in enumerate(pieces[i], 1):
            below = steps.get(_step(node, c))
            if below is None:
                below = steps[_step(node, c)] = len(falls)
                falls.append(0)
                own.append(-1)
                above.append((node, c))
                by_depth.extend([] for _ in range(depth + 1 - len(by_depth)))
                by_depth[depth].append(below)
            node = below
        own[node] = i
    ending, shorter = list(own), [-1] * len(pieces)
    for node in (n for level in by_depth[1:] for n in level):
        parent, c = above[node]
        if parent:
            at = falls[parent]
            while at and _step(at, c) not in steps:
                at = falls[at]
            falls[node] = steps.get(_step(at, c), 0)
        below = ending[falls[node]]
        if own[node] < 0:
            ending[node] = below
        else:
            shorter[own[node]] = below
    return steps, falls, ending, shorter


def _arrays(steps: dict[int, int], falls: list[int], ending: list[int], shorter: list[int]) -> dict[str, np.ndarray]:
    """The machine with its steps sorted by node and character."""
    froms, tos = np.array(list(steps), np.int64), np.array(list(steps.values()), np.int64)
    order = np.argsort(froms)
    lists = {"falls": falls, "ending": ending, "shorter": shorter}
    return {"froms": froms[order], "tos": tos[order]} | {n: np.array(x, np.int64) for n, x in lists.items()}


def _pair(left, right):
    return left << 32 | right


def _joins(ids: dict[str, int], rank: dict[int, float]) -> dict[str, np.ndarray]:
    """All pairs of pieces whose text is a piece, sorted, and its rank."""
    pairs = {
        _pair(ids[p[:cut]], ids[p[cut:]]): rank[i]
        for p, i in ids.items()
        for cut in range(1, len(p))
        if p[:cut] in ids and p[cut:] in ids
    }
    found = np.array(sorted(pairs), np.int64)
    return {"joins": found, "join_rank": np.array([pairs[x] for x in found.tolist()], np.float64)}


def _spines(pieces: int, rank: dict[int, float], parts: dict[int, tuple[int, int]]) -> dict[str, np.ndarray]:
    """``Encoder._spine`` of all pieces, end to end: those of the left side, then those of the right."""
    at, made, taken, starts = [], [], [], [0]
    for side in (0, 1):
        for piece in range(pieces):
            up = float("inf")
            while piece in parts:
                at.append(piece)
                made.append(rank[piece])
                taken.append(up)
                up, piece = rank[piece], parts[piece][side]
            at.append(piece)
            made.append(float("-inf"))
            taken.append(up)
            starts.append(len(at))
    return {
        "spine": np.array(at, np.int64),
        "made": np.array(made, np.float64),
        "taken": np.array(taken, np.float64),
        "spines": np.array(starts, np.int64),
    }


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted keys, and whether the wanted ones stand there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(sizes.sum())


def _shared(a: str, b: str) -> int:
    """Length of the prefix that two texts share."""
    shared, most = 0, min(len(a), len(b))
    while shared < most:
        half = (shared + most + 1) // 2
        shared, most = (half, most) if a[:half] == b[:half] else (shared, half - 1)
    return shared


def _last_merge(piece: str, ids: dict[str, int], rank: dict[int, float]) -> tuple[int, int] | None:
    """The two pieces that plain merging ends with before it has the whole piece."""
    symbols = list(piece)
    while True:
        merges = [
            (rank[ids[a + b]], at) for at, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in ids
        ]
        if not merges:
            return None
        at = min(merges)[1]
        if len(symbols) == 2:
            return (ids[symbols[0]], ids[symbols[1]]) if symbols[0] in ids and symbols[1] in ids else None
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]


class Encoder:
    """Encodes marked words, with states shared among sorted words."""

    def __init__(self, model: Model):
        self.model = model
        self._apart: dict[tuple[int, int], bool] = {}
        self._spines: dict[tuple[int, int], list[tuple[str, float, float]]] = {}
        # Pairs of pieces whose answer is known, one a slot, with the answer as last bit.
        self._pairs = np.full(1 << PAIR_BITS, -1, np.int64)
        self._forget()

    def _forget(self) -> None:
        """Words by number, and where the ids of each stand."""
        self._words: defaultdict[str, int] = defaultdict(count().__next__)
        self._ids = np.zeros(0, np.int32)
        self._starts = np.zeros(0, np.int64)
        self._sizes = np.zeros(0, np.int64)

    def _spine(self, piece: int, side: int) -> list[tuple[str, float, float]]:
        """The piece and its outermost parts on one side, each with the ranks of the merges that
        make it and take it up; a single character is there from the start."""
        known = self._spines.get((piece, side))
        if known is None:
            rank, parts = self.model.rank, self.model.parts
            at, taken, known = piece, float("inf"), []
            while at in parts:
                known.append((self.model.pieces[at], rank[at], taken))
                taken, at = rank[at], parts[at][side]
            known.append((self.model.pieces[at], float("-inf"), taken))
            self._spines[piece, side] = known
        return known

    def stays_apart(self, left: int, right: int) -> bool:
        """True where merging the text of both pieces ends with just these two."""
        rank, ids = self.model.rank, self.model.ids
        for a, a_made, a_taken in self._spine(left, 1):
            for b, b_made, b_taken in self._spine(right, 0):
                both = ids.get(a + b)
                # Ends meet while neither is taken up; on equal rank the left place goes first.
                if both is not None and a_made < b_taken and b_made < a_taken:
                    if rank[both] < a_taken and rank[both] <= b_taken:
                        return False
        return True

    def states(self, word: str, from_: int, last: list[int], nodes: list[int]) -> None:
        """Extend ``last``, the last piece of the path to each place, from place ``from_`` on.

        -1 stands for a character that goes to bytes.  ``nodes`` are the machine's.
        """
        m, apart = self.model, self._apart
        steps, falls, ending, shorter, lengths = m.steps, m.falls, m.ending, m.shorter, m.lengths
        del last[from_ + 1 :], nodes[from_ + 1 :]
        node = nodes[from_]
        for end in range(from_ + 1, len(word) + 1):
            code = ord(word[end - 1])
            after = steps.get(node << 21 | code)
            while after is None and node:
                node = falls[node]
                after = steps.get(node << 21 | code)
            node = after or 0
            nodes.append(node)
            piece = ending[node]
            while piece >= 0:
                before = last[end - lengths[piece]]
                if before < 0:  # a text's start, or bytes, which never merge
                    break
                pair = before, piece
                ok = apart.get(pair)
                if ok is None:
                    ok = apart[pair] = self.stays_apart(before, piece)
                if ok:
                    break
                piece = shorter[piece]
            last.append(piece)

    def _stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``stays_apart`` of many pairs; a slot taken by another pair is worked out anew."""
        pairs = _pair(left, right)
        slots = (pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)
        kept = self._pairs[slots]
        out = (kept & 1).astype(bool)
        new = np.flatnonzero(kept >> 1 != pairs)
        if len(new):
            out[new] = self._judged(left[new], right[new])
            self._pairs[slots[new]] = pairs[new] << 1 | out[new]
        return out

    def _judged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        t = self.model.arrays
        left = left + len(self.model.pieces)
        left_at = t["spines"][left]
        left_size = t["spines"][left + 1] - left_at
        right_at = t["spines"][right]
        right_size = t["spines"][right + 1] - right_at
        each = left_size * right_size
        of = np.repeat(np.arange(len(left)), each)
        nth = _runs(np.zeros(len(left), np.int64), each)
        a, b = left_at[of] + nth // right_size[of], right_at[of] + nth % right_size[of]
        at, joins = _found(t["joins"], _pair(t["spine"][a], t["spine"][b]))
        a, b, at, of = a[joins], b[joins], at[joins], of[joins]
        rank, a_taken, b_taken = t["join_rank"][at], t["taken"][a], t["taken"][b]
        torn = (t["made"][a] < b_taken) & (t["made"][b] < a_taken) & (rank < a_taken) & (rank <= b_taken)
        out = np.ones(len(left), bool)
        out[of[torn]] = False
        return out

    def _stepped(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The machine's nodes after one character more."""
        t = self.model.arrays
        out, nodes, open_ = np.zeros(len(nodes), np.int64), nodes.copy(), np.arange(len(nodes))
        while len(open_):
            at, found = _found(t["froms"], nodes[open_] << 21 | codes[open_])
            out[open_[found]] = t["tos"][at[found]]
            open_ = open_[~found]
            open_ = open_[nodes[open_] > 0]
            nodes[open_] = t["falls"][nodes[open_]]
        return out

    def _last_pieces(self, nodes: np.ndarray, places: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The last pieces of the paths to places, as ``states`` finds them."""
        t = self.model.arrays
        pieces = t["ending"][nodes]
        open_ = np.flatnonzero(pieces >= 0)
        while len(open_):
            piece = pieces[open_]
            before = last[places[open_] - t["lengths"][piece]]
            ok = before < 0
            asked = np.flatnonzero(~ok)
            ok[asked] = self._stay_apart(before[asked], piece[asked])
            open_ = open_[~ok]
            pieces[open_] = t["shorter"][pieces[open_]]
            open_ = open_[pieces[open_] >= 0]
        return pieces

    def _walk(self, words: list[str], codes: np.ndarray, lengths: np.ndarray, base: np.ndarray) -> np.ndarray:
        """``states`` of sorted words: place ``p`` of word ``w`` is at ``base[w] + p``."""
        last = np.full(len(codes) + len(words), NO_PIECE, np.int64)
        nodes = np.zeros(len(words), np.int64)
        starts = base - np.arange(len(words))
        longer, as_before, depth = np.arange(len(words)), np.ones(len(words), bool), 0
        while True:
            more = lengths[longer] > depth
            longer, as_before = longer[more], as_before[more]
            if len(longer) < FEW:
                break
            code = codes[starts[longer] + depth]
            as_before[0] = False
            as_before[1:] &= (longer[1:] == longer[:-1] + 1) & (code[1:] == code[:-1])
            first = np.flatnonzero(~as_before)
            node = self._stepped(nodes[longer[first]], code[first])
            piece = self._last_pieces(node, base[longer[first]] + depth + 1, last)
            prefix = np.cumsum(~as_before) - 1
            nodes[longer] = node[prefix]
            last[base[longer] + depth + 1] = piece[prefix]
            depth += 1
        before = ""
        for w, start in zip(longer.tolist(), base[longer].tolist()):
            word = words[w]
            shared = _shared(before, word)
            if shared <= depth:
                shared, path, passed = depth, last[start : start + depth + 1].tolist(), [0] * depth + [int(nodes[w])]
            self.states(word, shared, path, passed)
            last[start : start + len(word) + 1] = path
            before = word
        return last

    def _paths(self, last: np.ndarray, lengths: np.ndarray, base: np.ndarray) -> np.ndarray:
        """The pieces of the paths to the ends of words, each where it starts."""
        out, sizes = np.full(len(last), NO_PIECE, np.int64), self.model.arrays["lengths"]
        at, least = base + lengths, base
        while len(at) >= FEW:
            piece = last[at]
            to_bytes = piece < 0
            at = at - np.where(to_bytes, 1, sizes[piece])
            out[at] = np.where(to_bytes, BYTES, piece)
            more = at > least
            at, least = at[more], least[more]
        for end, start in zip(at.tolist(), least.tolist()):
            path, place = last[start : end + 1].tolist(), end - start
            while place:
                piece = path[place]
                place -= 1 if piece < 0 else self.model.lengths[piece]
                out[start + place] = BYTES if piece < 0 else piece
        return out

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of new words, which come in the order of their numbers."""
        if not words:
            return
        order = np.array(sorted(range(len(words)), key=words.__getitem__))
        words = [words[i] for i in order.tolist()]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        base = np.cumsum(lengths + 1) - lengths - 1
        pieces = self._paths(self._walk(words, codes, lengths, base), lengths, base)
        at = np.flatnonzero(pieces != NO_PIECE)
        ids, word = pieces[at], np.repeat(np.arange(len(words)), lengths + 1)[at]
        to_bytes = np.flatnonzero(ids == BYTES)
        if len(to_bytes):
            encoded = [chr(c).encode("utf-8", "surrogatepass") for c in codes[at[to_bytes] - word[to_bytes]].tolist()]
            times = np.ones(len(ids), np.int64)
            times[to_bytes] = list(map(len, encoded))
            ids, word = np.repeat(ids, times), np.repeat(word, times)
            ids[ids == BYTES] = self.model.arrays["bytes"][np.frombuffer(b"".join(encoded), np.uint8)]
        sizes, starts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        sizes[order] = found = np.bincount(word, minlength=len(words))
        starts[order] = np.cumsum(found) - found + len(self._ids)
        self._ids = np.concatenate([self._ids, ids.astype(np.int32)])
        self._starts = np.concatenate([self._starts, starts])
        self._sizes = np.concatenate([self._sizes, sizes])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts; an empty text has none."""
        ids, places = self.encode_flat(texts)
        ids, places = ids.tolist(), places.tolist()
        return [ids[a:b] for a, b in zip(places, places[1:])]

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one text after the other, and the places where texts start, with the end."""
        if len(self._words) > REMEMBERED:
            self._forget()
        known, number = len(self._words), self._words.__getitem__
        # Text by text, so that words seen before are dropped at once.
        numbers = [np.fromiter(map(number, self.cut(t)), np.int64) for t in texts]
        ends, words = np.cumsum([0, *map(len, numbers)]), np.concatenate([np.zeros(0, np.int64), *numbers])
        self._learn(list(islice(self._words, known, None)))
        sizes = self._sizes[words]
        places = np.concatenate([[0], np.cumsum(sizes)])[ends]
        return self._joined(self._ids[_runs(self._starts[words], sizes)], places)

    def cut(self, text: str) -> list[str]:
        """Marked words: a text's spaces are marks."""
        return self.model.words.findall(MARK + text.replace(" ", MARK)) if text else []

    def _joined(self, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join marks in a row: those no letter has taken up join among themselves."""
        marks = np.flatnonzero(ids == self.model.ids.get(MARK, NO_PIECE))
        follows = np.zeros(len(ids) + 1, bool)
        follows[marks + 1] = True
        follows[places] = False
        firsts = np.flatnonzero(~follows[marks])
        sizes = np.diff(firsts, append=len(marks))
        for run in np.unique(sizes[sizes > 1]).tolist():
            found = self._marks(run)
            starts = marks[firsts[sizes == run]]
            for nth, i in enumerate(found):
                ids[starts + nth] = i
            ids[_runs(starts + len(found), np.full(len(starts), run - len(found)))] = NO_PIECE
        stay = ids >= 0
        return ids[stay], np.concatenate([[0], np.cumsum(stay)])[places]

    def _marks(self, run: int) -> list[int]:
        """Ids of marks in a row: the longest pieces of marks from the left."""
        out = []
        while run:
            size = next(n for n in range(min(run, self.model.longest), 0, -1) if MARK * n in self.model.ids)
            out.append(self.model.ids[MARK * size])
            run -= size
        return out


def bytes_of(model: Model) -> list[bytes]:
    """What each id adds to a text; control pieces and unknown ones add nothing."""
    out = [p.replace(MARK, " ").encode() if i in model.rank else b"" for i, p in enumerate(model.pieces)]
    for value, i in enumerate(model.bytes_):
        out[i] = bytes([value])
    return out


def decode(ids: list[int], added: list[bytes]) -> str:
    """The text of ids, without the mark that encoding puts before it."""
    text = b"".join([added[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def texts_of(ids: np.ndarray, places: np.ndarray, added: pa.Array) -> Iterator[str]:
    """``decode`` of many texts, whose ids stand one after the other."""
    joined = added.take(pa.array(ids))
    ends = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :][places].tolist()
    data = joined.buffers()[2]
    for start, end in zip(ends, ends[1:]):
        text = str(data[start:end], "utf-8", "replace") if end > start else ""
        yield text[1:] if text.startswith(" ") else text


def encoded(docs: DataFrame, path: str = MODEL, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``ids`` and ``restored``: the ids of the whole text, and whether decoding gives it back.

    A null text has null in both; an empty one has no ids.  Only a text that itself holds
    the mark character is not restored, as its marks come back as spaces.  Rows are
    encoded one by one, so repeated ones and extra columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(read_model(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        encoder, added = Encoder(model), pa.array(bytes_of(model), pa.large_binary())
        for part in slices(batches, TRIE_TEXTS):
            texts = part.column(text).to_pylist()
            # A null text takes no place among the ids.
            ids, places = encoder.encode_flat([t or "" for t in texts])
            found = pa.ListArray.from_arrays(
                pa.array(places, pa.int32()), pa.array(ids, pa.int32()), mask=pa.array([t is None for t in texts])
            )
            back = texts_of(ids, places, added)
            same = [None if t is None else b == t for t, b in zip(texts, back)]
            yield extended(part, list(drop), {"ids": found, "restored": pa.array(same, pa.bool_())})

    return docs.mapInArrow(run, schema_of(docs, list(drop), "ids array<int>, restored boolean"))


def decoded(rows: DataFrame, path: str = MODEL, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of the ids; null ids have null, ids outside the model are refused."""
    shared = rows.sparkSession.sparkContext.broadcast(bytes_of(read_model(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [None if i is None else decode(i, shared.value) for i in part.column(ids).to_pylist()]
            yield extended(part, [], {"decoded": pa.array(found, pa.string())})

    return rows.mapInArrow(run, schema_of(rows, [], "decoded string"))


def document_ids(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """Result of the query and of the pipeline's last stage: ``doc_id, n_ids, ids, restored``."""
    found = encoded(take(docs, doc_id="doc_id", text="text"), path, drop=("text",))
    return found.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "ids", "restored")
