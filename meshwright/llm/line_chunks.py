"""Line dedup: content-defined chunks of lines.

Lines with words count; what stands between them belongs to the chunk around it.
A hash over the last ``span`` line hashes rolls along the worded lines. All but
one of ``spacing`` residues make a line a boundary, as do the first and the last
line and, in a stretch without any, every ``most``-th. Boundaries depend on the
lines just before them only, so text that is inserted before a passage does not
shift the chunks inside it. A chunk reaches from a boundary to the next, both
included: neighbours share a line, and each has two worded lines or more. A
chunk may match only up to a line between its boundaries, so its parts of two
worded lines or more that hold one of the two boundaries take part as well:
matches extend line by line, against all other places at once. Pieces are
compared across all documents, and all but the first place (smallest document
id, then smallest place) of equal ones are removed.

Every run of worded lines that occurs earlier and holds a line that is a boundary
in both places goes whole (stretches of ``most`` lines without any aside). ``drop_repeated_runs`` takes all pairs of neighbouring
worded lines as pieces; it is the exact rule that the chunks are measured by.

Hashes only nominate; equal pieces are grouped by their bytes.

Cases: null and empty texts have no piece and stay as they are; one-line texts
never change; documents without an id come last in the order, and those that
share an id are ordered by their text, so that of repeated rows one stays;
a text whose worded lines all go becomes empty; other columns pass through, and
input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshwright.llm.common import restored, set_aside, small_batches
from meshwright.session import cut

ODD = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
SPACES = " \t\n\v\f\r"
PARTS = 64
LineHash = Callable[[bytes], int]
Pieces = Callable[[list[str]], list[tuple[int, int]]]


def line_hash(line: bytes) -> int:
    return xxhash.xxh64_intdigest(line)


def chunk_hash(chunk: bytes) -> bytes:
    return xxhash.xxh64_digest(chunk)


def worded_lines(lines: list[str]) -> list[int]:
    return [k for k, line in enumerate(lines) if line.strip(SPACES)]


def boundaries(lines: list[str], hash_of: LineHash = line_hash, span: int = 2, spacing: int = 8, most: int = 16) -> list[int]:
    """Places of boundaries among ``lines``, which all have words."""
    found, hashes = [], [hash_of(line.encode()) for line in lines]
    for k in range(len(lines)):
        rolled = 0
        for h in hashes[max(0, k - span + 1):k + 1]:
            rolled = (rolled * ODD + h) & MASK
        if (rolled >> 40) % spacing or k in (0, len(lines) - 1) or k - found[-1] >= most:
            found.append(k)
    return found


def chunk_lines(lines: list[str], hash_of: LineHash = line_hash, **options) -> list[tuple[int, int]]:
    """Chunks and their parts at a boundary, as (first line, line after the last), in the order of the text."""
    worded = worded_lines(lines)
    edges = boundaries([lines[k] for k in worded], hash_of, **options)
    pieces = []
    for a, b in zip(edges, edges[1:], strict=False):
        between = range(a + 1, b)
        pieces += [(a, b), *((a, k) for k in between), *((k, b) for k in between)]
    return [(worded[a], worded[b] + 1) for a, b in sorted(pieces)]


def line_pairs(lines: list[str]) -> list[tuple[int, int]]:
    """Each worded line with the next one, as (first line, line after the last)."""
    worded = worded_lines(lines)
    return [(a, b + 1) for a, b in zip(worded, worded[1:], strict=False)]


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows equal in id and text are one document: the id and a hash of the text name it."""
    return docs.select(F.col(key).alias("__id"), F.xxhash64(text).alias("__version"), F.col(text).alias("__text"))


PLACE = ["__id", "__version", "__chunk"]


def _order() -> F.Column:
    return F.struct(F.col("__id").isNull().alias("late"), *PLACE)


def repeated_pieces(docs: DataFrame, key: str, text: str, pieces: Pieces, piece_hash: Callable[[bytes], bytes]) -> DataFrame:
    """Places of all pieces whose bytes occur earlier: __id, __version and the list __chunks."""
    keyed = _keyed(docs, key, text)
    id_type = keyed.schema["__id"].dataType.simpleString()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__text"):
            rows, places, found = [], [], []
            for k, body in enumerate(batch.column("__text").to_pylist()):
                lines = (body or "").split("\n")
                for place, (a, b) in enumerate(pieces(lines)):
                    rows.append(k)
                    places.append(place)
                    found.append(piece_hash("\n".join(lines[a:b]).encode()))
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id").take(take), batch.column("__version").take(take), pa.array(places, pa.int32()), pa.array(found, pa.binary())],
                names=[*PLACE, "hash"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__text"):
            rows, places, found = [], [], []
            for k, (body, wanted) in enumerate(zip(batch.column("__text").to_pylist(), batch.column("__chunks").to_pylist(), strict=True)):
                lines = body.split("\n")
                chunks = pieces(lines)
                for place in wanted:
                    a, b = chunks[place]
                    rows.append(k)
                    places.append(place)
                    found.append("\n".join(lines[a:b]))
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id").take(take), batch.column("__version").take(take), pa.array(places, pa.int32()), pa.array(found, pa.string())],
                names=[*PLACE, "chunk"])

    head = f"__id {id_type}, __version bigint, __chunk int"
    places = cut(keyed.mapInArrow(hashes, f"{head}, hash binary"), "chunks")
    place = F.xxhash64(*PLACE)  # repeated rows are one place
    twice = places.groupBy("hash").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b").select("hash")
    nominated = places.join(twice, "hash").groupBy("__id", "__version").agg(F.collect_set("__chunk").alias("__chunks"))
    # Now the bytes: only nominated chunks travel with their text.
    spoken = cut(_with_list(keyed, nominated, "inner").mapInArrow(texts, f"{head}, chunk string"), "chunk-text")
    # A chunk may be everywhere: its places meet the first one in as many parts as they are dealt to.
    dealt = spoken.withColumn("part", F.pmod(F.xxhash64(*PLACE), F.lit(PARTS)))
    first = dealt.groupBy("chunk", "part").agg(F.min(_order()).alias("first")).groupBy("chunk").agg(
        F.min("first").alias("first"), F.collect_set("part").alias("parts")).select("chunk", "first", F.explode("parts").alias("part"))
    later = dealt.join(first, ["chunk", "part"]).where(_order() != F.col("first"))
    return later.groupBy("__id", "__version").agg(F.collect_set("__chunk").alias("__chunks"))


def _with_list(keyed: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    # The lists grow with the texts: one plan at every size, without a broadcast while they happen to be small.
    other = lists.select(F.col("__id").alias("__i"), F.col("__version").alias("__v"), "__chunks").hint("merge")
    same = keyed["__id"].eqNullSafe(other["__i"]) & (keyed["__version"] == other["__v"])
    return keyed.join(other, same, how).drop("__i", "__v")


def drop_repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text",
                       pair_hash: Callable[[bytes], bytes] = xxhash.xxh64_digest) -> DataFrame:
    """``docs`` without all runs of two worded lines or more that start earlier, with n_lines and n_removed of each row."""
    return _drop(docs, key, text, line_pairs, pair_hash)


def drop_repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", hash_of: LineHash = line_hash,
                         chunk_hash_of: Callable[[bytes], bytes] = chunk_hash, **options) -> DataFrame:
    """``docs`` with the text that is left without repeated chunks, and n_lines and n_removed of each row."""
    return _drop(docs, key, text, lambda lines: chunk_lines(lines, hash_of, **options), chunk_hash_of)


def _drop(docs: DataFrame, key: str, text: str, pieces: Pieces, piece_hash: Callable[[bytes], bytes]) -> DataFrame:
    """Without the repeated pieces; blank lines go too where no worded line is left."""
    repeated = cut(repeated_pieces(docs, key, text, pieces, piece_hash), "repeated")
    kept, inner = set_aside(docs, ("n_lines", "n_removed"))
    names, key, text = list(inner.values()), inner[key], inner[text]

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, text):
            bodies, counts, gone = [], [], []
            for body, wanted in zip(batch.column(text).to_pylist(), batch.column("__chunks").to_pylist(), strict=True):
                lines = body.split("\n") if body else []
                chunks = pieces(lines) if wanted else []
                drop = {k for place in wanted or () for k in range(*chunks[place])}
                if drop and drop.issuperset(worded_lines(lines)):
                    drop = set(range(len(lines)))
                bodies.append(body if not drop else "\n".join(x for k, x in enumerate(lines) if k not in drop))
                counts.append(len(lines))
                gone.append(len(drop))
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(bodies, pa.string()) if c == text else batch.column(c) for c in names], pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
                names=[*names, "n_lines", "n_removed"])

    rows = kept.select(*names, F.col(key).alias("__id"), F.xxhash64(text).alias("__version"))
    schema = T.StructType([*kept.schema, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    return _with_list(rows, repeated, "left").drop("__id", "__version").mapInArrow(strip, schema).select(*restored(inner), "n_lines", "n_removed")
