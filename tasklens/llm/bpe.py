"""Byte-level BPE as a lazily determinised transducer, and a streaming UTF-8 decoder (dealt operator 9).

Merging pairs by rank gives, for every prefix of a piece, one last token. A sequence of tokens is what merging yields if
each neighbouring pair is: encoding the two tokens' bytes gives those two tokens back. That makes encoding a finite-state
problem. A state is a set of hypotheses (last whole token, place in the trie of the token begun after it, tokens not yet
agreed on); reading a byte moves all of them, and what all of them agree on is emitted. A hypothesis lives no longer than
the longest token, which bounds the lookahead. States and arcs are made when first met. Once as many states are kept as
memory is set aside for, what leaves them is simulated hypothesis by hypothesis, so rare pieces cost no states.
"""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tasklens.llm.resident import resident

MAX_STATES = 20_000
MAX_PIECES = 125_000
MAX_PAIRS = 400_000
# Pieces longer than this are read by the transducer each time.
KEPT_PIECE_CHARS = 32

_ROOT = 0
_NEVER = 1 << 62


class _State:
    __slots__ = ("arcs", "final", "hypotheses")

    def __init__(self, hypotheses: tuple):
        self.hypotheses = hypotheses
        self.arcs: dict[int, tuple[tuple[int, ...], _State]] = {}
        # What is still owed if the piece ends here: the tokens of the hypothesis that ends with a whole token.
        self.final = next((out for _, node, out in hypotheses if node == _ROOT), ())


class Transducer:
    """Encodes pieces of bytes by the ranks of a byte-level vocabulary."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        self.bytes_of = {i: t for t, i in ranks.items()}
        self._child: dict[int, int] = {}
        self._inner: set[int] = set()
        self._token: dict[int, int] = {}
        nodes = 1
        for token, rank in ranks.items():
            node = _ROOT
            for byte in token:
                key = node << 8 | byte
                self._inner.add(node)
                if key not in self._child:
                    self._child[key] = nodes
                    nodes += 1
                node = self._child[key]
            self._token[node] = rank
        self._pairs: dict[int, bool] = {}
        self._made_of: dict[int, tuple[int, int] | None] = {}
        self._start = _State(((None, _ROOT, ()),))
        self._states = {self._start.hypotheses: self._start}

    def merge(self, piece: bytes, until: int = 1) -> list[bytes]:
        """Merging by rank, done literally, until so many parts are left; for the few bytes of a token."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > until:
            rank, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == _NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a single byte. A token that merging never gives is its own bytes."""
        if token not in self._made_of:
            parts = self.merge(self.bytes_of[token], 2)
            self._made_of[token] = (self.ranks[parts[0]], self.ranks[parts[-1]]) if len(parts) == 2 else None
        return self._made_of[token]

    def _may_follow(self, last: int | None, token: int) -> bool:
        """Whether merging the bytes of two tokens gives the two back: no merge across their border comes in time."""
        if last is None:
            return len(self.merge(self.bytes_of[token])) == 1
        key = last << 32 | token
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._stay_apart(last, token)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        # Undo the merges next to the border, the latest first. Whenever the parts at the border could merge before the
        # merge just undone, they would have. On a tie of ranks the leftmost merge comes first.
        bytes_of, ranks = self.bytes_of, self.ranks
        due_left = due_right = _NEVER
        while True:
            across = ranks.get(bytes_of[left] + bytes_of[right], _NEVER)
            if across < due_left and across <= due_right and across != _NEVER:
                return False
            halves_left, halves_right = self._halves(left), self._halves(right)
            if halves_left is None and halves_right is None:
                return True
            if halves_right is None or (halves_left is not None and left > right):
                due_left, due_right = min(due_left, left), min(due_right, left - 1)
                left = halves_left[1]
            else:
                due_left, due_right = min(due_left, right + 1), min(due_right, right)
                right = halves_right[0]

    def _arc(self, state: _State, byte: int) -> tuple[tuple[int, ...], _State] | None:
        """The arc for a byte, made now; None if no more states may be kept."""
        if len(self._states) >= self.max_states:
            return None
        alive, ended = [], None
        for last, node, out in state.hypotheses:
            node = self._child.get(node << 8 | byte)
            if node is None:
                continue
            if node in self._inner:
                alive.append((last, node, out))
            # Each prefix has one last token only, so the first that fits is it.
            if ended is None:
                token = self._token.get(node)
                if token is not None and self._may_follow(last, token):
                    ended = (token, _ROOT, (*out, token))
        alive.append(ended)
        if len(alive) == 1:
            agreed = ended[2]
            hypotheses = ((ended[0], _ROOT, ()),)
        else:
            agreed = tuple(os.path.commonprefix([h[2] for h in alive]))
            n = len(agreed)
            hypotheses = tuple([(last, node, out[n:]) for last, node, out in alive]) if n else tuple(alive)
        following = self._states.get(hypotheses)
        if following is None:
            following = self._states[hypotheses] = _State(hypotheses)
        arc = (agreed, following)
        state.arcs[byte] = arc
        return arc

    def encode(self, piece: bytes) -> list[int]:
        # A piece that is a token as a whole is that token, whatever merging would give.
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        ids: list[int] = []
        state = self._start
        for at, byte in enumerate(piece):
            arc = state.arcs.get(byte) or self._arc(state, byte)
            if arc is None:
                return ids + self._simulate(state, piece[at:])
            emitted, state = arc
            if emitted:
                ids += emitted
        ids += state.final
        return ids

    def _simulate(self, state: _State, rest: bytes) -> list[int]:
        """What is emitted from a state on, without making states: its hypotheses one by one, the longest token first.

        Each prefix has one last token, so a prefix is gone on from once only; where that fails it is never tried again.
        """
        child, tokens, pairs, size = self._child, self._token, self._pairs, len(rest)

        def ahead(node: int, at: int) -> list[tuple[int, int]]:
            """(prefix length, token) of every token that ends after ``at``, shortest first."""
            found = []
            while at < size:
                node = child.get(node << 8 | rest[at])
                if node is None:
                    break
                at += 1
                token = tokens.get(node)
                if token is not None:
                    found.append((at, token))
            return found

        tried: set[int] = set()
        for first, node, owed in state.hypotheses:
            path, last = [], [first]
            open_ends = [ahead(node, 0)]
            while open_ends:
                ends = open_ends[-1]
                if not ends:
                    open_ends.pop()
                    last.pop()
                    if path:
                        path.pop()
                    continue
                at, token = ends.pop()
                if at in tried:
                    continue
                before = last[-1]
                fits = None if before is None else pairs.get(before << 32 | token)
                if not (self._may_follow(before, token) if fits is None else fits):
                    continue
                path.append(token)
                if at == size:
                    return [*owed, *path]
                tried.add(at)
                last.append(token)
                open_ends.append(ahead(_ROOT, at))
        raise ValueError("a byte that is no token of the vocabulary")


class _Pieces(dict):
    """The ids of short pieces met before. When full, it becomes the older half, whose pieces stay if they are met again."""

    def __init__(self, transducer: Transducer):
        super().__init__()
        self.transducer = transducer
        self._older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self._older.get(piece)
        if ids is None:
            ids = tuple(self.transducer.encode(piece.encode()))
        if len(piece) <= KEPT_PIECE_CHARS:
            if len(self) >= MAX_PIECES:
                self._older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Utf8Machine:
    """Incremental UTF-8: feed bytes, get the text that is complete; malformed parts become U+FFFD.

    The state is the bytes of a character begun. A byte that cannot go on with it ends the malformed part before it,
    as the Unicode standard recommends.
    """

    def __init__(self):
        self.pending = b""

    @staticmethod
    def _length(lead: int) -> int:
        if lead < 0x80:
            return 1
        if 0xC2 <= lead <= 0xDF:
            return 2
        if 0xE0 <= lead <= 0xEF:
            return 3
        return 4 if 0xF0 <= lead <= 0xF4 else 0

    @staticmethod
    def _second(lead: int, byte: int) -> bool:
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
        return low <= byte <= high

    def feed(self, data: bytes) -> str:
        out, pending = [], bytearray(self.pending)
        for byte in data:
            if pending:
                fits = self._second(pending[0], byte) if len(pending) == 1 else 0x80 <= byte <= 0xBF
                if fits:
                    pending.append(byte)
                    if len(pending) == self._length(pending[0]):
                        out.append(pending.decode())
                        pending.clear()
                    continue
                out.append("�")
                pending.clear()
            length = self._length(byte)
            if length == 1:
                out.append(chr(byte))
            elif length:
                pending.append(byte)
            else:
                out.append("�")
        self.pending = bytes(pending)
        return "".join(out)

    def end(self) -> str:
        left, self.pending = self.pending, b""
        return "�" if left else ""


class Codec:
    """Texts to ids and back, by one vocabulary file and one pattern that cuts texts into pieces."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._cut = regex.compile(pattern)
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self._pieces: _Pieces | None = None
        # A token that is whole characters needs no state when none is pending.
        self._whole: dict[int, str | None] = {}
        for token, rank in ranks.items():
            machine = Utf8Machine()
            text = machine.feed(token)
            self._whole[rank] = None if machine.pending or "�" in text else text

    def encode(self, text: str) -> array:
        if len(text) < 1 << 20:
            pieces = self._cut.findall(text)
        else:
            pieces = (m.group() for m in self._cut.finditer(text))
        if self._pieces is None:
            self._pieces = _Pieces(Transducer(self.ranks))
        return array("I", chain.from_iterable(map(self._pieces.__getitem__, pieces)))

    def decode(self, ids: array) -> str:
        try:
            return "".join(map(self._whole.__getitem__, ids))
        except TypeError:
            return "".join(self.decode_stream(ids))

    def decode_stream(self, ids: array) -> Iterator[str]:
        """The text as it becomes complete, id by id; an id that is not in the vocabulary is an error."""
        machine, whole, bytes_of = Utf8Machine(), self._whole, self.bytes_of
        for i in ids:
            text = whole[i]
            if text is None or machine.pending:
                text = machine.feed(bytes_of[i])
            yield text
        yield machine.end()


def codec(path: str, pattern: str) -> Codec:
    """The codec of a vocabulary; a worker keeps it, and what it has met, until it works for another operator."""
    return resident((path, pattern), lambda: Codec(path, pattern))


def _others(df: DataFrame, *replaced: str) -> list[str]:
    return [c for c in df.columns if c not in replaced]


def _ids_of(own: Codec, texts: pa.Array) -> list[array]:
    return [own.encode(text.as_py() or "") for text in texts]


def _texts_of(own: Codec, packed: Iterable[bytes | None]) -> pa.Array:
    texts = []
    for body in packed:
        ids = array("I")
        ids.frombytes(body or b"")
        texts.append(own.decode(ids))
    return pa.array(texts, pa.string())


def _mapped(
    df: DataFrame, source: str, kept: list[str], new: str, step: Callable[[Codec, pa.Array], list[pa.Array]], path: str, pattern: str
) -> DataFrame:
    """The columns ``kept`` and the ``new`` ones that ``step`` makes of the column ``source``, batch by batch."""
    ordered = df.select(F.col(source).alias("_source"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(kept)])
    added = [c.split()[0] for c in new.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            columns = [*batch.columns[1:], *step(own, batch.column(0))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[1:], *added])

    types = dict(df.dtypes)
    out = ordered.mapInArrow(run, ", ".join([*[f"_{i} {types[c]}" for i, c in enumerate(kept)], new]))
    return out.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(kept)], *added)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``ids``, the token ids as little-endian unsigned 32-bit integers, and ``n_tokens``.

    ``path`` names the rank file, present on every machine; ``pattern`` cuts a text into the pieces that are merged each
    for itself. Special tokens are ordinary text. Null and empty texts have no ids. Rows stay where they are: nothing is
    shuffled. Columns called ``ids`` or ``n_tokens`` are replaced; ``keep_text`` leaves the text among the columns.
    """
    def step(own: Codec, texts: pa.Array) -> list[pa.Array]:
        ids = _ids_of(own, texts)
        return [pa.array([i.tobytes() for i in ids], pa.binary()), pa.array(map(len, ids), pa.int64())]

    kept = _others(docs, "ids", "n_tokens", *([] if keep_text else [text_col]))
    return _mapped(docs, text_col, kept, "ids binary, n_tokens long", step, path, pattern)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add ``decoded``, the text of packed ``ids``. Null ids decode to the empty text; a column ``decoded`` is replaced."""
    kept = _others(df, out_col)
    out = _mapped(df, ids_col, kept, "_decoded string", lambda own, ids: [_texts_of(own, ids.to_pylist())], path, pattern)
    return out.withColumnRenamed("_decoded", out_col)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass: adds ``ids``, ``n_tokens`` and ``decoded``.

    One after the other, the two need a Python worker each for every task, and as many tables.
    """
    def step(own: Codec, texts: pa.Array) -> list[pa.Array]:
        packed = [i.tobytes() for i in _ids_of(own, texts)]
        counts = pa.array([len(body) // 4 for body in packed], pa.int64())
        return [pa.array(packed, pa.binary()), counts, _texts_of(own, packed)]

    kept = _others(docs, "ids", "n_tokens", "decoded", *([] if keep_text else [text_col]))
    return _mapped(docs, text_col, kept, "ids binary, n_tokens long, decoded string", step, path, pattern)
