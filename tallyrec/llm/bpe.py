"""Byte-level BPE by recursive DuckDB queries inside the partitions.

A text is cut into pieces by the tokenizer's pattern. The distinct new pieces of a slice of texts
become token-position rows; a recursive query joins neighbouring tokens with the merge table and
contracts, in every piece, the leftmost pair of the smallest rank until no pair is left. Decoding is
an ordered aggregation of the tokens' bytes. Texts are then put together from their pieces' tokens.

The merge table holds every pair of tokens whose joined bytes are a token; the rank of the joined
token is the rank of the pair. Pieces that are tokens as they stand are not merged at all. A long piece
is first cut at every place that no token occurring in the piece lies across: nothing is ever
contracted there.

A worker remembers the tokens of what stood between two spaces from one task to the next, up to a
bound in bytes; beyond it the older half goes. Bytes are remembered only where decoding gives
something else than was encoded, so the text itself serves as its own decoded form.
"""

from __future__ import annotations

import base64
import hashlib
import tempfile
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrec.llm.batches import release_memory, slices, texts

PIECES_AT_ONCE = 16_384
LONG_PIECE = 128  # bytes; longer pieces contract all places of a pair at once where that is safe
SLICE_BYTES = 8 << 20  # of texts at a time
CACHED_BYTES = 64 << 20  # remembered by a worker, with what Python needs for an entry
ENTRY_BYTES = 220
CACHED_CHUNKS = 550_000
DUCKDB_MEMORY = "256MB"

_AFTER_SPACE, _START_OF_TEXT, _AFTER_SEAM = range(3)

# One contraction per round: the leftmost pair of the smallest rank.
_MERGE_ONE = """
with recursive step(n, w, ids) as (
    select 0, w, ids from start
    union all (
    with tokens as (
        select w, unnest(ids) as id, unnest(ids[2:]) as following,
               generate_subscripts(ids, 1) as pos
        from step
    ),
    best as (
        select w, min(merged::bigint << 32 | pos) as best
        from tokens join merges on (id::bigint << 32 | following) = pair
        group by w
    )
    select n + 1, w, ids[:(best & 4294967295) - 1] || [(best >> 32)::int]
                     || ids[(best & 4294967295) + 2:]
    from step join best using (w))
)
select w, arg_max(ids, n) as ids from step group by w order by w
"""

# All places of the smallest rank in one round, left to right without overlap. Only for tokens that
# no pair of a smaller rank contains, as otherwise a contraction could come between.
_MERGE_ALL = """
with recursive step(w, ids) using key (w) as (
    select w, ids from start
    union (
    with tokens as (
        select w, unnest(ids) as id, unnest(ids[2:]) as following,
               generate_subscripts(ids, 1) as pos
        from step
    ),
    ranked as (
        select tokens.*, merged, safe
        from tokens left join merges on (id::bigint << 32 | following) = pair
    ),
    least as (select w, min(merged) as merged from ranked group by w having count(merged) > 0),
    hits as (
        select w, pos, merged, safe,
               row_number() over (partition by w order by pos) as number,
               pos - row_number() over (partition by w order by pos) as run
        from ranked join least using (w, merged)
    ),
    picked as (
        select w, pos, merged from hits
        qualify (safe or number = 1)
            and row_number() over (partition by w, run order by pos) % 2 = 1
    )
    select r.w, list(coalesce(own.merged, r.id) order by r.pos)
    from ranked r semi join least using (w)
    left join picked own on own.w = r.w and own.pos = r.pos
    left join picked before on before.w = r.w and before.pos = r.pos - 1
    where before.pos is null
    group by r.w)
)
select w, ids from step order by w
"""

_DECODE = """
select w, unhex(string_agg(hex, '' order by pos)) as decoded
from (select w, unnest(ids) as id, generate_subscripts(ids, 1) as pos from encoded)
join vocabulary using (id)
group by w order by w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens and ranks of a rank file: base64 and number, a line each."""
    with open(path, "rb") as file:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, file) if t}


class Codec:
    """Encodes and decodes texts in one Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.seam = regex.compile(r"(?<=\S) (?=\S)")
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.con: duckdb.DuckDBPyConnection | None = None
        pairs = np.array(
            [
                (ranks[t[:i]] << 32 | ranks[t[i:]], r, ranks[t[:i]], ranks[t[i:]])
                for t, r in ranks.items()
                for i in range(1, len(t))
                if t[:i] in ranks and t[i:] in ranks
            ],
            np.int64,
        ).reshape(-1, 4)
        unsafe = np.unique(np.concatenate([pairs[pairs[:, 1] < pairs[:, c], c] for c in (2, 3)]))
        self.tables = {
            "merges": pa.table(
                {
                    "pair": pairs[:, 0],
                    "merged": pairs[:, 1].astype(np.int32),
                    "safe": ~np.isin(pairs[:, 1], unsafe),
                }
            ),
            "vocabulary": pa.table(
                {"id": np.array(list(ranks.values()), np.int32), "hex": [t.hex() for t in ranks]}
            ),
        }
        self.prefixes: set[bytes] | None = None
        self._forget()

    def _open(self) -> None:
        """Connect to a DuckDB of this process's own, with the vocabulary's tables."""
        self.con = duckdb.connect()
        self.con.execute(f"set threads = 1; set memory_limit = '{DUCKDB_MEMORY}'")
        self.con.execute("set temp_directory = ?", [tempfile.gettempdir()])
        for name, table in self.tables.items():
            self._table(name, table)

    def _table(self, name: str, table: pa.Table) -> None:
        self.con.register("_new", table)
        self.con.execute(f"create or replace table {name} as select * from _new")
        self.con.unregister("_new")

    def _forget(self) -> None:
        # by kind of chunk: the tokens, and the decoded bytes where they are not the chunk's own
        self.ids = ({}, {}, {})
        self.decoded = ({}, {}, {})
        self.held = 0

    def _drop_older_half(self) -> None:
        self.ids = tuple(dict(islice(own.items(), (len(own) + 1) // 2, None)) for own in self.ids)
        kept = zip(self.decoded, self.ids)
        self.decoded = tuple({c: d for c, d in own.items() if c in ids} for own, ids in kept)
        self.held = sum(ENTRY_BYTES * len(own) + sum(map(len, own)) for own in self.ids)
        self.held += sum(len(tokens) for own in self.ids for tokens in own.values() if tokens)

    def query(self, query: str, name: str, lists: pa.Array) -> pa.Table:
        """The result of a query over a table of numbered token lists."""
        if self.con is None:
            self._open()
        self._table(name, pa.table({"w": np.arange(len(lists), dtype=np.int32), "ids": lists}))
        return self.con.sql(query).to_arrow_table()

    def _lists(self, query: str, name: str, values: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The second column of a query over token lists, in the order of their numbers."""
        offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
        found = self.query(query, name, pa.ListArray.from_arrays(offsets, pa.array(values)))
        return found.column(1).combine_chunks()

    def release(self) -> None:
        """Give back all but what is remembered. DuckDB keeps what its queries took until it is closed."""
        while self.held > CACHED_BYTES:
            self._drop_older_half()
        if self.con is not None:
            self.con.close()
            self.con = None
        release_memory()

    def _segments(self, piece: bytes) -> list[bytes]:
        """The piece cut wherever no token that occurs in it lies across."""
        if self.prefixes is None:
            self.prefixes = {token[:i] for token in self.ranks for i in range(2, len(token) + 1)}
        found, begin, reach = [], 0, 1
        for at in range(len(piece)):
            if at >= reach:
                found.append(piece[begin:at])
                begin = at
            reach = max(reach, at + 1)
            length = 2
            while (part := piece[at : at + length]) in self.prefixes and len(part) == length:
                if at + length > reach and part in self.ranks:
                    reach = at + length
                length += 1
        return [*found, piece[begin:]]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[list[bytes], list[bytes]]:
        """Tokens (little-endian unsigned 32-bit) and decoded bytes of distinct pieces."""
        tokens, decoded = [b""] * len(pieces), [b""] * len(pieces)
        cut: dict[int, list[bytes]] = {}
        short, long_ = [], []
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                tokens[i], decoded[i] = rank.to_bytes(4, "little"), piece
            elif len(piece) <= LONG_PIECE:
                short.append(i)
            elif len(segments := self._segments(piece)) > 1:
                cut[i] = segments
            else:
                long_.append(i)
        for own, query in ((short, _MERGE_ONE), (long_, _MERGE_ALL)):
            for at in range(0, len(own), PIECES_AT_ONCE):
                part = own[at : at + PIECES_AT_ONCE]
                flat = np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)
                ends = np.cumsum([len(pieces[i]) for i in part])
                lists = self._lists(query, "start", self.byte_ids[flat], ends)
                values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()[1:]
                packed = values.astype("<u4").tobytes()
                texts_ = self._lists(_DECODE, "encoded", values, ends).to_pylist()
                begin = 0
                for i, end, text in zip(part, (4 * ends.astype(np.int64)).tolist(), texts_, strict=True):
                    tokens[i], decoded[i] = packed[begin:end], text
                    begin = end
        if cut:
            parts = list({segment for segments in cut.values() for segment in segments})
            own = dict(zip(parts, zip(*self.encode_pieces(parts))))
            for i, segments in cut.items():
                tokens[i], decoded[i] = (b"".join(x) for x in zip(*(own[s] for s in segments)))
        return tokens, decoded

    def _keep(self, kind: int, chunk: str, tokens: bytes | None, decoded: bytes | None = None) -> None:
        self.ids[kind][chunk] = tokens
        self.held += ENTRY_BYTES + len(chunk) + len(tokens or b"")
        if decoded is not None:
            self.decoded[kind][chunk] = decoded

    def _learn(self, *chunks: set[str]) -> None:
        """Encode new chunks by kind: between two spaces of the text, at its start, and after a seam.

        A seam is a space between two characters that are no white space; pieces never lie across
        one. A space of another kind is found by the chunks next to it, which get no tokens. A piece
        that is remembered as a chunk is not encoded again.
        """
        numbers: dict[str, int] = {}
        plain: list[list[str]] = []
        cut: list[tuple[int, str, list[str]]] = []
        words, odd = self.ids[_AFTER_SPACE], self.decoded[_AFTER_SPACE]
        for kind, some in enumerate(chunks):
            lead = "" if kind == _START_OF_TEXT else " "
            new = some - self.ids[kind].keys()
            plain.append([c for c in new if c.isalpha()])  # a single piece
            for chunk in plain[kind]:
                numbers.setdefault(lead + chunk, len(numbers))
            for chunk in new.difference(plain[kind]):
                if kind == _AFTER_SPACE and (
                    not chunk or chunk[0].isspace() or chunk[-1].isspace()
                ):
                    self._keep(kind, chunk, None)
                else:
                    cut.append((kind, chunk, self.pattern.findall(lead + chunk)))
        known: dict[str, bytes] = {}
        for _, _, found in cut:
            for piece in found:
                own = words.get(piece[1:]) if piece[0] == " " and piece[1:].isalpha() else None
                if own is not None and piece[1:] not in odd:
                    known[piece] = own
                else:
                    numbers.setdefault(piece, len(numbers))
        raw = [p.encode() for p in numbers]
        tokens, decoded = self.encode_pieces(raw)
        known.update(zip(numbers, tokens))
        changed = {p: d for p, d, r in zip(numbers, decoded, raw) if d != r}
        for kind, some in enumerate(plain):
            lead = "" if kind == _START_OF_TEXT else " "
            own = [known[lead + chunk] for chunk in some]
            self.ids[kind].update(zip(some, own))
            self.held += ENTRY_BYTES * len(some) + sum(map(len, some)) + sum(map(len, own))
            if changed:
                odd_ones = {c: changed[lead + c] for c in some if lead + c in changed}
                self.decoded[kind].update(odd_ones)
        for kind, chunk, found in cut:
            own, whole = None, len(chunk) + (kind != _START_OF_TEXT)
            if changed and not changed.keys().isdisjoint(found) or sum(map(len, found)) != whole:
                own = b"".join([changed.get(p, p.encode()) for p in found])
            self._keep(kind, chunk, b"".join([known[p] for p in found]), own)

    def encode(self, some: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Per text its tokens as little-endian unsigned 32-bit integers, and their bytes."""
        if self.held > CACHED_BYTES or sum(map(len, self.ids)) > CACHED_CHUNKS:
            self._drop_older_half()
        # a text is cut anew each time: the chunks of all texts at once would take ten times the texts,
        # and what is remembered of them would lie scattered over that memory
        after: set[str] = set()
        begins: set[str] = set()
        for text in some:
            begin, *rest = text.split(" ")
            begins.add(begin)
            after.update(rest)
        self._learn(after, begins)
        known = self.ids[_AFTER_SPACE]
        loose = {chunk for chunk in after if known[chunk] is None}
        kinds, seamed = [], set()
        begins.clear()
        for text in some:
            begin, *rest = text.split(" ") if loose else text.split(" ", 1)
            if rest and (not begin or begin[-1].isspace() or loose and not loose.isdisjoint(rest)):
                begin, *rest = self.seam.split(text)
                begins.add(begin)
                seamed.update(rest)
                kinds.append(_AFTER_SEAM)
            else:
                kinds.append(_AFTER_SPACE)
        self._learn(set(), begins, seamed)
        for text, kind in zip(some, kinds, strict=True):
            begin, *rest = text.split(" ") if kind == _AFTER_SPACE else self.seam.split(text)
            ids = b"".join([self.ids[_START_OF_TEXT][begin], *map(self.ids[kind].__getitem__, rest)])
            yield ids, self._decoded(text, begin, rest, kind)

    def _decoded(self, text: str, begin: str, rest: list[str], kind: int) -> bytes:
        first, others = self.decoded[_START_OF_TEXT], self.decoded[kind]
        if begin not in first and (not others or others.keys().isdisjoint(rest)):
            return text.encode()
        parts = [first.get(begin, begin.encode())]
        return b"".join([*parts, *(others.get(c, b" " + c.encode()) for c in rest)])


_CODECS: dict[str, Codec] = {}


def _codec(ranks: Broadcast, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    data, name = ranks.value
    if name + pattern not in _CODECS:
        _CODECS.clear()
        _CODECS[name + pattern] = Codec(data, pattern)
    return _CODECS[name + pattern]


# what each result column is made of: a document's ids and decoded bytes
_COLUMNS = {
    "n_tokens": (pa.int64(), lambda ids, decoded: len(ids) // 4),
    "ids": (pa.list_(pa.int32()), lambda ids, decoded: np.frombuffer(ids, "<i4")),
    "decoded": (pa.binary(), lambda ids, decoded: decoded),
    "ids_sha256": (pa.string(), lambda ids, decoded: hashlib.sha256(ids).hexdigest()),
    "decoded_sha256": (pa.string(), lambda ids, decoded: hashlib.sha256(decoded).hexdigest()),
}
_KINDS = {
    "n_tokens": "long",
    "ids": "array<int>",
    "decoded": "binary",
    "ids_sha256": "string",
    "decoded_sha256": "string",
}


def _encoder(ranks: Broadcast, pattern: str, columns: Sequence[str], slice_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        try:
            for batch in slices(batches, "text", size=slice_bytes):
                values: list[list] = [[] for _ in columns]
                for found in codec.encode([t.decode() for t in texts(batch, "text")]):
                    for own, name in zip(values, columns, strict=True):
                        own.append(_COLUMNS[name][1](*found))
                arrays = [pa.array(v, _COLUMNS[n][0]) for v, n in zip(values, columns, strict=True)]
                yield pa.record_batch([batch.column("doc_id"), *arrays], ["doc_id", *columns])
        finally:
            codec.release()

    return run


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    columns: Sequence[str] = ("n_tokens", "ids", "decoded"),
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """The tokens of every document, and the text decoded from them.

    Returns ``doc_id`` and the named ``columns``: ``n_tokens``, ``ids``, ``decoded`` (the bytes of the
    ids), ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256``, both in lower-case hexadecimal.

    ``ranks_path`` names a file of ranks that holds all 256 bytes; ``pattern`` cuts a text into pieces,
    each encoded by itself, and must let a space stand only at the start of a piece or among
    white space. A worker takes texts of about ``slice_bytes`` at a time: fewer need less memory and more
    time, the tokens are the same. Special tokens are ordinary text. One row per row of ``docs``; a null or empty text
    has no tokens. Null and repeated ids are kept as they are, other columns ignored; an
    empty table gives an empty result.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    # a vocabulary has some ten thousand tokens, whatever the corpus
    ranks = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), ranks_path))
    schema = ", ".join(["doc_id long", *(f"{name} {_KINDS[name]}" for name in columns)])
    return slim.mapInArrow(_encoder(ranks, pattern, tuple(columns), slice_bytes), schema)


def _decoder(ranks: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, "")
        try:
            for batch in batches:
                found = codec.query(_DECODE, "encoded", batch.column("ids"))
                text = [b""] * batch.num_rows
                for w, own in zip(found["w"].to_pylist(), found["decoded"].to_pylist(), strict=True):
                    text[w] = own
                yield pa.record_batch([batch.column("doc_id"), pa.array(text, pa.binary())], ["doc_id", "decoded"])
        finally:
            codec.release()

    return run


def decode_documents(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id`` and ``decoded``, the bytes of ``ids``; no ids or null give no bytes, and an id that
    is not in the vocabulary is left out."""
    slim = encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    ranks = encoded.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), ranks_path))
    return slim.mapInArrow(_decoder(ranks), "doc_id long, decoded binary")
