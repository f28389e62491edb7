"""Operator 5: SentencePiece encoding and decoding by an Aho-Corasick driven Viterbi.

The vocabulary is that of a SentencePiece model file (a parameter; nothing is
trained here).  Spaces become ``U+2581`` and one is put in front of a text, as
the format has it.  An Aho-Corasick automaton over the pieces reads each
character once; at every position the output links list the pieces that end
there, longest first, and relax the best score from the position where each
begins.  The path with the highest sum of piece scores wins; on equal sums the
longer last piece.  A character that no piece covers costs ten less than the
worst piece and is written as its UTF-8 byte pieces.

No piece of a SentencePiece vocabulary has a space mark behind another
character, so no piece reaches over the start of a run of spaces, and the best
path of a text is that of its stretches between them, one behind the other.
The same holds in front of a run of punctuation, for the characters that no
piece has behind a letter or digit (found from the pieces).  The stretches are
solved one by one and kept in a bounded memo per worker.  A vocabulary with a
space mark inside a piece is run over whole texts instead.

The driver reads the model and broadcasts it: its size is that of the
vocabulary and doesn't depend on the documents.

Defined results: null text has null ids and null decoded text; empty text has
no ids; a literal ``U+2581`` in a text is written as bytes, so decoding gives
back every text exactly; ids outside the vocabulary and control pieces decode
to nothing; extra columns stay (a column named like a new one is replaced).
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siniestro.llm.columns import set_aside

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
PENALTY = 10.0
MEMO = 150_000
MEMO_CHARS = 64
TOGETHER = 4 << 20
"""Bytes of text whose stretches are solved together (a longer text alone)."""


class Automaton:
    """Aho-Corasick over strings: per state its moves, failure state, own piece and output link."""

    def __init__(self, pieces: list[tuple[str, float, int]]) -> None:
        self.moves: list[dict[str, int]] = [{}]
        self.piece: list[tuple[int, float, int] | None] = [None]  # length, score, id
        for text, score, number in pieces:
            at = 0
            for ch in text:
                to = self.moves[at].get(ch)
                if to is None:
                    to = self.moves[at][ch] = len(self.moves)
                    self.moves.append({})
                    self.piece.append(None)
                at = to
            self.piece[at] = (len(text), score, number)
        self.fail = [0] * len(self.moves)
        self.outputs: list[tuple[tuple[int, float, int], ...]] = [()] * len(self.moves)
        queue = deque(self.moves[0].values())
        while queue:
            at = queue.popleft()
            own = self.piece[at]
            below = self.outputs[self.fail[at]]
            self.outputs[at] = (own, *below) if own else below
            for ch, to in self.moves[at].items():
                back = self.fail[at]
                while back and ch not in self.moves[back]:
                    back = self.fail[back]
                self.fail[to] = self.moves[back].get(ch, 0)
                queue.append(to)


class Vocabulary:
    """Pieces, scores and byte pieces of a model; the automaton is built where it is used."""

    def __init__(self, pieces: list[tuple[str, float, int]], byte_ids: list[int], size: int) -> None:
        self.pieces, self.byte_ids, self.size = pieces, byte_ids, size
        self.unknown = min((s for _, s, _ in pieces), default=0.0) - PENALTY
        self.stretch = self._stretches()

    def _stretches(self) -> str | None:
        """A pattern of the stretches that no piece reaches out of; None if there are no such stretches."""
        pairs = {pair for p, _, _ in self.pieces for pair in zip(p, p[1:], strict=False)}
        if any(b == MARK != a for a, b in pairs):
            return None
        apart = {chr(c) for c in range(33, 127)} - {c for c in map(chr, range(128)) if c.isalnum()}
        if not any("\n" in pair for pair in pairs):
            apart.add("\n")
        while bad := {b for a, b in pairs if b in apart and a != MARK and a not in apart}:
            apart -= bad
        if not apart:
            return r" *[^ ]+| +"
        cls = "".join(map(re.escape, sorted(apart)))
        return rf" *(?:[^ {cls}]+|[{cls}]+[^ {cls}]*)| +"

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("automaton", "memo", "spelled", "cut")}

    @cached_property
    def automaton(self) -> Automaton:
        return Automaton(self.pieces)

    @cached_property
    def cut(self) -> re.Pattern | None:
        return re.compile(self.stretch) if self.stretch else None

    @cached_property
    def memo(self) -> _Memo:
        return _Memo()

    @cached_property
    def spelled(self) -> list[bytes]:
        """The bytes of every id."""
        out = [b""] * self.size
        for text, _, number in self.pieces:
            out[number] = text.replace(MARK, " ").encode()
        for byte, number in enumerate(self.byte_ids):
            out[number] = bytes([byte])
        return out

    def best(self, stretches: list[str]) -> Iterator[list[int]]:
        """Ids of the best path of every stretch (spaces not yet marked).

        Scores up to a position depend on nothing behind it, so a stretch
        goes on from where it parts from the one before: sorted stretches
        share most of their way.
        """
        a = self.automaton
        moves, fail, outputs, unknown = a.moves, a.fail, a.outputs, self.unknown
        score, step, states = [0.0], [(0, 0)], [0]  # step: length and id of the last piece
        last = ""
        for stretch in stretches:
            same = 0
            for x, y in zip(last, stretch, strict=False):
                if x != y:
                    break
                same += 1
            last = stretch
            del score[same + 1:], step[same + 1:], states[same + 1:]
            state = states[same]
            for i in range(same, len(stretch)):
                ch = stretch[i]
                if ch == " ":
                    ch = MARK
                elif ch == MARK:
                    ch = ""
                to = moves[state].get(ch)
                while to is None and state:
                    state = fail[state]
                    to = moves[state].get(ch)
                state = to or 0
                top, how, length = -1e300, (1, -1), 0
                for length, own, number in outputs[state]:
                    value = score[i + 1 - length] + own
                    if value > top:
                        top, how = value, (length, number)
                if length != 1 and score[i] + unknown > top:  # outputs end with the shortest
                    top, how = score[i] + unknown, (1, -1)
                score.append(top)
                step.append(how)
                states.append(state)
            ids: list[int] = []
            i = len(stretch)
            while i:
                length, number = step[i]
                i -= length
                if number >= 0:
                    ids.append(number)
                else:
                    ids.extend(self.byte_ids[b] for b in reversed(stretch[i].encode()))
            yield ids[::-1]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as packed 32-bit numbers."""
        if self.cut is None:
            return [_pack(ids) for text in texts for ids in self.best([" " + text] if text else [""])]
        memo = self.memo
        if len(memo) > MEMO:
            memo.turn()
        parts = [self.cut.findall(" " + text) if text else [] for text in texts]
        unknown = []
        for stretch in set(chain.from_iterable(parts)).difference(memo):
            packed = memo.before.get(stretch)
            if packed is None:
                unknown.append(stretch)
            else:
                memo[stretch] = packed
        unknown.sort()
        for stretch, ids in zip(unknown, self.best(unknown), strict=True):
            memo[stretch] = _pack(ids)
        out = [b"".join(map(memo.__getitem__, part)) for part in parts]
        for stretch in unknown:
            if len(stretch) > MEMO_CHARS:
                del memo[stretch]
        return out

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < self.size)]
        raw = b"".join(map(self.spelled.__getitem__, ids.tolist()))
        return raw.removeprefix(b" ").decode(errors="replace")


def _pack(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class _Memo(dict):
    """Packed ids by stretch; what was asked for since the last turn, and what was there before it."""

    def __init__(self) -> None:
        super().__init__()
        self.before: dict[str, bytes] = {}

    def turn(self) -> None:
        self.before = dict(self)
        self.clear()


def load(path: str = MODEL) -> Vocabulary:
    """Read a SentencePiece model file (on the driver)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError(f"{path} has no byte pieces")
    special = {i for i in range(size)
               if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    return Vocabulary([(model.id_to_piece(i), model.get_score(i), i) for i in range(size) if i not in special],
                      byte_ids, size)


def _mapped(frame: DataFrame, vocabulary: Vocabulary, source: str, kind: str, made: dict[str, str], make) -> DataFrame:
    """``frame`` with the columns ``made`` (name: type) from ``source`` batch by batch."""
    away, back = set_aside(frame, *made)
    given = frame.select(*away, F.col(source).cast(kind).alias("_in"))
    outs = [f"_out{i}" for i in range(len(made))]
    schema = given.drop("_in").select(
        "*", *(F.lit(None).cast(t).alias(o) for o, t in zip(outs, made.values(), strict=True))).schema
    shared = frame.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = make(shared.value, batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], *outs])

    return given.mapInArrow(work, schema).select(
        *back, *(F.col(o).alias(name) for o, name in zip(outs, made, strict=True)))


def _encode_batch(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
    packed: list[bytes | None] = [None] * len(texts)
    some: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if text.is_valid:
            some.append(i)
            size += len(text.as_buffer())
        if some and (size > TOGETHER or i + 1 == len(texts)):
            for k, ids in zip(some, vocabulary.encode([texts[k].as_py() for k in some]), strict=True):
                packed[k] = ids
            some, size = [], 0
    offsets = np.zeros(len(packed) + 1, np.int32)
    np.cumsum([len(p or b"") // 4 for p in packed], out=offsets[1:])
    values = pa.array(np.frombuffer(b"".join(p for p in packed if p), np.int32))
    null = pa.array([p is None for p in packed], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=null)


def _decode_batch(vocabulary: Vocabulary, lists: pa.Array) -> pa.Array:
    offsets = lists.offsets.to_numpy()
    values = lists.values.fill_null(-1).to_numpy(zero_copy_only=False)
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    return pa.array([vocabulary.decode(values[a:b]) if ok else None
                     for a, b, ok in zip(offsets[:-1], offsets[1:], valid, strict=True)], pa.string())


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the piece ids of column ``text``."""
    return _mapped(docs, vocabulary, text, "string", {ids: "array<int>"}, lambda v, x: [_encode_batch(v, x)])


def decode(frame: DataFrame, vocabulary: Vocabulary, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``frame`` with the text that column ``ids`` spells."""
    return _mapped(frame, vocabulary, ids, "array<int>", {text: "string"}, lambda v, x: [_decode_batch(v, x)])


def encode_and_decode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "token_ids",
                      decoded: str = "decoded") -> DataFrame:
    """:func:`encode`, then :func:`decode` of its ids, in one pass over the rows."""
    def both(v: Vocabulary, texts: pa.Array) -> list[pa.Array]:
        coded = _encode_batch(v, texts)
        return [coded, _decode_batch(v, coded)]

    return _mapped(docs, vocabulary, text, "string", {ids: "array<int>", decoded: "string"}, both)


def round_trip(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, token_ids, n_tokens, decoded_sha256): texts encoded, and the ids decoded again."""
    vocabulary = load(model)
    both = encode_and_decode(docs.select("doc_id", "text"), vocabulary)
    return both.select("doc_id", "token_ids", F.coalesce(F.size("token_ids"), F.lit(0)).cast("long").alias("n_tokens"),
                       F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


QUERIES = {"op5_sentencepiece": op5_sentencepiece}
ORACLE: dict[str, str] = {}
