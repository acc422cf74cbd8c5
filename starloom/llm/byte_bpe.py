"""Byte-level BPE encoding and decoding, by recursive DuckDB queries inside each task.

A text is cut by the split pattern. The distinct pieces of a batch that are no single token become
token-position rows, one per byte, and one recursive query contracts them: each step finds every
piece's leftmost pair of least rank in the merge table, replaces its left row and drops its right
row, until no piece has a pair left. Token ids are the aggregate of the last rows in order.
Decoding joins the rows with the vocabulary and aggregates the bytes in order.

The merge table holds every cut of a vocabulary entry into two entries, so a pair's rank is the
rank of its bytes, as in the tiktoken library. Places run through a whole batch, with a separator
row after each piece, so one order serves all pieces.

Pieces longer than LONG bytes contract all occurrences of their least rank in one step, left to
right. In a trained vocabulary a merge never makes a pair of lower rank than its own possible, so
the result is the same, with one step per rank instead of one per merge.

The pass is narrow. A worker keeps about `keep` pieces (some 400 bytes each) in its cache, for all
its tasks, and a query gets about ROWS rows, plus one piece. Beyond its memory limit DuckDB spills
to Spark's scratch folder.

Null and empty texts have no tokens and decode to nothing; null ids stay null; repeated rows each
give a row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import map_texts

ROWS = 250_000
KEEP = 400_000
LONG = 128
#: Tokens of a vocabulary, at most: a pair of ids is one number, left id times IDS plus right id.
IDS = 65536
#: Steps of one recursive query over long pieces, whose rows all stay until it ends.
LONG_STEPS = 16

FINAL = """
, finished AS (
  SELECT s.word, s.pos, s.tok FROM steps s
  JOIN (SELECT word, max(step) AS last FROM steps GROUP BY word) t ON s.word = t.word AND s.step = t.last
  WHERE s.tok >= 0)
"""

#: One pair per piece and step. key is rank and place of the pair that begins at a row.
CONTRACT = f"""
WITH RECURSIVE steps AS (
  SELECT 0 AS step, word, pos, tok, (m.rank::BIGINT << 32) | pos AS key
  FROM (SELECT *, tok::BIGINT * {IDS} + lead(tok) OVER (ORDER BY pos) AS pair FROM start) s LEFT JOIN merges m ON m.pair = s.pair
  UNION ALL
  SELECT step, word, pos, tok, (m.rank::BIGINT << 32) | pos AS key
  FROM (
    SELECT step + 1 AS step, word, pos, tok,
      tok::BIGINT * {IDS} + lead(tok) OVER (ORDER BY pos) AS pair
    FROM (
      SELECT p.step, p.word, p.pos, CASE WHEN p.key = b.best THEN (b.best >> 32)::INT ELSE p.tok END AS tok
      FROM (SELECT *, lag(key) OVER (ORDER BY pos) AS before FROM steps) p
      JOIN (SELECT word, min(key) AS best FROM steps WHERE key IS NOT NULL GROUP BY word) b ON p.word = b.word
      WHERE p.before IS NULL OR p.before <> b.best)
  ) s LEFT JOIN merges m ON m.pair = s.pair)
"""

#: All pairs of a piece's least rank per step; of adjoining ones every second.
CONTRACT_LONG = f"""
WITH RECURSIVE steps AS (
  SELECT 0 AS step, word, pos, tok, m.rank AS key
  FROM (SELECT *, tok::BIGINT * {IDS} + lead(tok) OVER (ORDER BY pos) AS pair FROM start) s LEFT JOIN merges m ON m.pair = s.pair
  UNION ALL
  SELECT step, word, pos, tok, m.rank AS key
  FROM (
    SELECT step + 1 AS step, word, pos, tok,
      tok::BIGINT * {IDS} + lead(tok) OVER (ORDER BY pos) AS pair
    FROM (
      SELECT step, word, pos, CASE WHEN merged THEN best ELSE tok END AS tok, lag(merged) OVER (ORDER BY pos) AS gone
      FROM (
        SELECT *, hit AND (row - max(CASE WHEN hit THEN 0 ELSE row END) OVER (ORDER BY pos ROWS UNBOUNDED PRECEDING)) % 2 = 1 AS merged
        FROM (
          SELECT p.*, b.best, p.key IS NOT DISTINCT FROM b.best AS hit, row_number() OVER (ORDER BY pos) AS row
          FROM steps p JOIN (SELECT word, min(key) AS best FROM steps WHERE key IS NOT NULL GROUP BY word) b
            ON p.word = b.word
          WHERE p.step < {LONG_STEPS})))
    WHERE gone IS NOT TRUE
  ) s LEFT JOIN merges m ON m.pair = s.pair)
"""

TOKENS = """
SELECT f.word, list(f.tok ORDER BY f.pos) AS ids, unhex(string_agg(v.hex, '' ORDER BY f.pos)) AS bytes
FROM finished f JOIN vocabulary v ON v.id = f.tok GROUP BY f.word
"""


class Codec:
    """One worker's merge table, split pattern and cache of encoded pieces."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        ranks = self.ranks
        if max(ranks.values()) >= IDS:
            raise ValueError(f"token ids must be below {IDS}")
        self.split = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        cuts = [
            (ranks[token[:i]] * IDS + ranks[token[i:]], rank)
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        scratch = os.environ.get("SPARK_LOCAL_DIRS")
        if scratch:
            folder = os.path.join(scratch.split(",")[0], f"bpe-{os.getpid()}")
            self.con.execute(f"SET temp_directory = '{folder}'")
        merges = pa.table([pa.array([c[0] for c in cuts], pa.int64()), pa.array([c[1] for c in cuts], pa.int32())], ["pair", "rank"])
        words = pa.table([pa.array(ranks.values(), pa.int32()), pa.array([t.hex() for t in ranks])], ["id", "hex"])
        for name, table in (("merges", merges), ("vocabulary", words)):
            self.con.register("given", table)
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.con.unregister("given")
        self.cache: dict[str, tuple[str, int, bytes, bytes]] = {}
        self.with_ids, self.most = True, KEEP

    def use(self, with_ids: bool, most: int) -> None:
        """Settings of a task; pieces that an earlier one cached without their ids don't serve one that needs them."""
        if with_ids and not self.with_ids:
            self.cache.clear()
        self.with_ids, self.most = with_ids, most

    def keep(self, piece: str, ids: list[int], decoded: bytes) -> None:
        packed = np.array(ids, np.int32).tobytes() if self.with_ids else b""
        self.cache[piece] = (" ".join(map(str, ids)), len(ids), decoded, packed)

    def start(self, pieces: list[bytes]) -> pa.Table:
        sizes = np.array([len(p) + 1 for p in pieces])
        raw = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
        tok = self.byte[raw]
        tok[np.cumsum(sizes) - 1] = -1
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        return pa.table([word, np.arange(len(raw), dtype=np.int32), tok], ["word", "pos", "tok"])

    def contract(self, pieces: list[str], encoded: list[bytes]) -> None:
        self.con.register("start", self.start(encoded))
        if len(encoded[0]) > LONG:
            found = self.contract_long()
        else:
            found = self.con.execute(CONTRACT + FINAL + TOKENS).fetchall()
        self.con.unregister("start")
        for word, ids, decoded in found:
            self.keep(pieces[word], ids, decoded)

    def contract_long(self) -> list[tuple[int, list[int], bytes]]:
        rows = None
        while True:
            steps = self.con.execute(
                CONTRACT_LONG
                + "SELECT word, pos, tok FROM steps s JOIN (SELECT word AS w, max(step) AS last FROM steps GROUP BY word)"
                + " ON word = w AND step = last ORDER BY pos"
            ).to_arrow_table()
            if rows is not None and steps.num_rows == rows.num_rows:
                break
            rows = steps
            self.con.unregister("start")
            self.con.register("start", rows)
        return self.con.execute(f"WITH finished AS (SELECT * FROM start WHERE tok >= 0) {TOKENS}").fetchall()

    def encode(self, texts: list[str]) -> list[list[str]]:
        """The pieces of each text; afterwards the cache holds every one of them."""
        if len(self.cache) > self.most:
            self.cache.clear()
        cut = [self.split(text) for text in texts]
        short: list[tuple[str, bytes]] = []
        rows = 0
        for piece in set().union(*cut).difference(self.cache):
            encoded = piece.encode()
            if encoded in self.ranks:
                self.keep(piece, [self.ranks[encoded]], encoded)
            elif len(encoded) > LONG:
                self.contract([piece], [encoded])
            else:
                short.append((piece, encoded))
                rows += len(encoded) + 1
                if rows > ROWS:
                    self.contract(*map(list, zip(*short)))
                    short, rows = [], 0
        if short:
            self.contract(*map(list, zip(*short)))
        return cut


@lru_cache(maxsize=1)
def codec(ranks_path: str, pattern: str) -> Codec:
    return Codec(ranks_path, pattern)


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    keep: int = KEEP,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array<int>).

    keep bounds a worker's cache of pieces; a smaller one takes less memory and more time.
    """

    def make():
        worker = codec(ranks_path, pattern)
        worker.use(with_ids, keep)

        def work(_, texts: list[str]) -> list[pa.Array]:
            cut, known = worker.encode(texts), worker.cache
            counts, ids_sha, text_sha, ids = [], [], [], []
            for pieces in cut:
                found = [known[p] for p in pieces]
                counts.append(sum(f[1] for f in found))
                ids_sha.append(hashlib.sha256(" ".join([f[0] for f in found]).encode()).hexdigest())
                text_sha.append(hashlib.sha256(b"".join([f[2] for f in found])).hexdigest())
                if with_ids:
                    ids.append(b"".join([f[3] for f in found]))
            columns = [pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), flat))
            return columns

        return work

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return map_texts(docs, id_col, text_col, make, fields, batch_rows=512)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and decoded (binary) of token arrays; a null or empty array decodes to nothing."""
    source = tokens.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = codec(ranks_path, pattern).con
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                ids = part.column(1)
                rows = pa.table(
                    [ids.value_parent_indices(), np.arange(len(ids.flatten())), ids.flatten()], ["word", "pos", "tok"]
                )
                con.register("finished", rows)
                bytes_of = {word: decoded for word, _, decoded in con.execute(TOKENS).fetchall()}
                con.unregister("finished")
                decoded = [bytes_of.get(i, b"") for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(decoded, pa.binary())], ["doc_id", "decoded"])

    return source.mapInArrow(run, "doc_id long, decoded binary")
