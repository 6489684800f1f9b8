"""Similarity join of whole texts by the Jaccard similarity of their five-word shingles, over a token-group matrix.

A-Z is lowered, words are runs of anything but ASCII white space; a document's set is its distinct five-word shingles, with fewer words
the whole sequence, without words nothing. Two documents link when 100 * intersection >= 80 * union; empty sets link with
nothing. Linked documents are in one component, named by its smallest ``doc_id``. Shingles stand for their XXH64 hash.

Equal sets collapse to a class first. A class links with another only if the rest of the table, taken as one group, covers it, so:

1. *Screen.* With the hashes in ascending order, similar classes share a few of the lowest quarter of each. Classes that share too few
   of these with anything are done. Of the others all hashes are counted; a class with less than four fifths of its set in
   another one is done as well.
2. *Order.* What is left orders its hashes by how many classes have them, rare ones first. The longer of two similar classes has one that
   they share in the first fifth of this order, its probe, and the shorter has it in the first ninth, its index.
3. *Groups.* Similar classes are put into groups: classes with the same least hash under each of a few mixings are dealt into small
   groups and compared there; the one with the fewest hashes of its own, as the origin of copies is, is put into each of these. The
   components of the links, cut into parts of bounded size and alike in length, are the groups.
4. *Matrix.* A row (token, group) says that a member has the token in its index; a group row holds the union of its members' tokens.
   The probe of a class, the query, meets the matrix, by token; its own component is left out, as it adds nothing, and groups whose
   lengths or tokens of others' do not allow the overlap. In the group's task the query's overlap with the union bounds its overlap
   with any member: groups under the bound stay closed, in the others the members are compared one by one.

A crowd of near copies is one component after step 3, at a cost in proportion to its size, and is never paired in step 4. Texts
that share passages without being similar meet by their rarest tokens only, a group at a time. Nothing is dropped: each bound
follows from the threshold, and equal hashes of different shingles only let more pass to the comparison.

Edge cases: a null text is empty; a document with an empty set is a component of its own, rows that share its id among them; a null
``doc_id`` never names a component unless no other does; repeated rows and equal texts are one class; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from lexmill.llm.common import SLICE_ROWS, checkpointed, keyed_texts, map_slices
from lexmill.llm.components import component_labels
from lexmill.session import broadcast_if_small

SHINGLE_WORDS = 5
SEED = 42
#: The least similarity in hundredths.
PERCENT = 80
#: Most members of a group; a group of the first comparison may have twice as many.
GROUP = 32
#: Mixings whose least hash brings similar classes together.
MIXINGS = 3
#: Queries that one slice of a group meets.
SLICE_QUERIES = 512
#: The screen looks at this many tokens of a hundred beyond the prefix.
SPARE = 5


def shingle_set(text: bytes) -> np.ndarray:
    """The distinct shingle hashes of a UTF-8 text in ascending order, unsigned."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= SHINGLE_WORDS:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], stops[:-SHINGLE_WORDS]]).tolist()
    spans = zip(starts, (stops[SHINGLE_WORDS - 1 :] - 1).tolist())
    return np.unique(np.array([digest(joined[start:stop], SEED) for start, stop in spans], np.uint64))


def similar(common: int, left: int, right: int) -> bool:
    return 100 * common >= PERCENT * (left + right - common)


def _least_overlap(size: Column) -> Column:
    """Tokens that a set of ``size`` shares with any similar one, at least."""
    return F.ceil(size * PERCENT / 100).cast("int")


def _classes(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(``(doc_id, class, size)`` of each row, the texts); the class is a digest of the set, null for an empty one."""
    texts = keyed_texts(df, id_col, text_col).select("doc_id", F.encode("text", "UTF-8").alias("raw"))
    id_type = to_arrow_type(texts.schema["doc_id"].dataType)
    schema = pa.schema([("doc_id", id_type), ("class", pa.binary()), ("size", pa.int64())])

    def work(ids: list, raws: list[bytes]) -> list[list]:
        sets = [shingle_set(raw) for raw in raws]
        return [ids, [_class(hashes) for hashes in sets], [len(hashes) for hashes in sets]]

    return checkpointed(map_slices(texts, work, schema)), texts


def _class(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def _sets(texts: DataFrame, wanted: DataFrame, cut: int | None = None) -> DataFrame:
    """``(class, size, hashes)`` made again from the text of each ``wanted(least_id)``; the lowest ``cut`` hundredths only, if given.

    Rows that repeat an id may repeat a class or add one; what follows takes sets of classes.
    """
    wanted = broadcast_if_small(wanted.select("least_id"), 16)
    asked = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("least_id")), "left_semi").select("raw")
    schema = pa.schema([("class", pa.binary()), ("size", pa.int32()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                made = [shingle_set(raw) for raw in batch.slice(start, SLICE_ROWS).column(0).to_pylist()]
                made = [hashes for hashes in made if len(hashes)]
                kept = [hashes if cut is None else hashes[: _screened(len(hashes), cut)] for hashes in made]
                offsets = np.cumsum([0, *map(len, kept)])
                values = np.concatenate([np.empty(0, np.uint64), *kept]).view(np.int64)
                columns = [
                    pa.array([_class(hashes) for hashes in made], pa.binary()),
                    pa.array([len(hashes) for hashes in made], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return asked.mapInArrow(run, from_arrow_schema(schema))


def _screened(size: int, spare: int) -> int:
    """The length of the screen's prefix: tokens of which similar sets share one, and ``spare`` hundredths more."""
    return min(size, size - -(-PERCENT * size // 100) + -(-spare * size // 100))


def _shared_tokens(sets: DataFrame) -> DataFrame:
    """``(id, token, n)`` for each hash of a set that ``n`` sets have, more than one.

    The count and the join read one shuffle of the tokens: the count takes the ids as well, or it would ask for a second one without them.
    """
    tokens = sets.select("id", F.explode("hashes").alias("token")).repartition("token")
    many = tokens.groupBy("token").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))
    return tokens.join(many.filter("first < last").select("token", "n"), "token")


def _numbered(sets: DataFrame) -> DataFrame:
    """Write the sets with an ``id`` for each, which is shorter than a class."""
    return checkpointed(sets.withColumn("id", F.monotonically_increasing_id()))


def _screen(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes that share enough of their lowest hashes with others."""
    lowest = _numbered(_sets(texts, classes, SPARE))
    shared = _shared_tokens(lowest).groupBy("id").agg(F.count("*").alias("shared"))
    # a similar set may be smaller by a fifth, and then looks at that much less beyond its prefix
    least = F.ceil(_least_overlap(F.col("size")) * SPARE / 100)
    passed = lowest.select("id", "class", "size").join(shared, "id").filter(F.col("shared") >= least)
    passed = checkpointed(passed.select("class").distinct())
    return checkpointed(classes.join(broadcast_if_small(passed, 48), "class", "left_semi"))


def candidate_sets(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """``(id, class, size, hashes)`` of the classes that may link, each once."""
    sets = _numbered(_sets(texts, _screen(texts, classes)))
    repeated = sets.groupBy("class").agg(F.min("id").alias("kept"), F.count("*").alias("n")).filter("n > 1")
    extra = sets.select("id", "class").join(repeated, "class").filter("id <> kept").select("id")
    return sets.join(broadcast_if_small(checkpointed(extra), 16), "id", "left_anti")


def _ranked(sets: DataFrame) -> DataFrame:
    """``(id, size, covered, probe, index_length)`` of the classes that others cover well enough.

    ``covered`` counts the tokens that other classes have. Tokens of no other class come first in the common order, so the others
    have what is left of a prefix: ``probe`` holds those of the longer one of a pair, its first ``index_length`` those of the shorter one.
    """
    ordered = F.sort_array(F.collect_list(F.struct("n", "token"))).alias("all")
    ranked = _shared_tokens(sets).groupBy("id").agg(ordered).join(sets.select("id", "size"), "id")
    covered, size = F.size("all"), F.col("size")
    probe = F.slice("all", F.lit(1), F.greatest(covered - _least_overlap(size) + 1, F.lit(0)))
    index = covered - F.ceil(size * 2 * PERCENT / (100 + PERCENT)).cast("int") + 1
    found = ranked.filter(covered >= _least_overlap(size)).select(
        "id",
        "size",
        covered.alias("covered"),
        F.transform(probe, lambda one: one["token"]).alias("probe"),
        F.greatest(index, F.lit(0)).alias("index_length"),
    )
    return checkpointed(found)


def _overlap(left: np.ndarray, right: np.ndarray) -> int:
    """Common values of two ascending arrays of distinct values."""
    small, large = (left, right) if len(left) <= len(right) else (right, left)
    if not len(small):
        return 0
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int(np.count_nonzero(large[at] == small))


def _ascending(scalar: pa.Scalar) -> np.ndarray:
    return np.sort(scalar.values.to_numpy(zero_copy_only=False))


_LINKS = "a long, b long"


def _links_table(links: list[tuple[int, int]]) -> pa.Table:
    return pa.table({name: pa.array([link[n] for link in links], pa.int64()) for n, name in enumerate("ab")})


def _links_within(sets: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(a, b)``: links between classes that are dealt into one small group by their least mixed hash, for each mixing."""

    def least(mixing: int) -> Column:
        return F.array_min(F.transform("hashes", lambda token: F.xxhash64(token, F.lit(mixing))))

    mixed = [F.struct(F.lit(n).alias("mixing"), least(n).alias("least")) for n in range(MIXINGS)]
    own = broadcast_if_small(ranked.select("id", (F.col("size") - F.col("covered")).alias("own")), 32)
    keyed = checkpointed(sets.join(own, "id").select("id", "own", F.inline(F.array(*mixed))))
    hub = F.min_by("id", F.struct("own", "id")).alias("hub")
    crowds = keyed.groupBy("mixing", "least").agg(F.count("*").alias("n"), hub).filter("n > 1")
    crowds = crowds.withColumn("parts", F.ceil(F.col("n") / GROUP).cast("int"))
    part = F.pmod(F.xxhash64("id", "mixing"), F.col("parts")).alias("part")
    members = keyed.join(crowds, ["mixing", "least"]).select("id", "mixing", "least", part)
    parts = F.explode(F.sequence(F.lit(0), F.col("parts").cast("long") - 1)).alias("part")
    hubs = crowds.filter("parts > 1").select(F.col("hub").alias("id"), "mixing", "least", parts)
    dealt = broadcast_if_small(checkpointed(members.unionByName(hubs).distinct()), 64)

    def compare(table: pa.Table) -> pa.Table:
        names, arrays = table.column("id").to_pylist(), [_ascending(value) for value in table.column("hashes")]
        root, links = list(range(len(names))), []

        def find(n: int) -> int:
            while root[n] != n:
                n = root[n]
            return n

        for n in range(len(names)):
            for m in range(n):
                if find(n) != find(m) and similar(_overlap(arrays[n], arrays[m]), len(arrays[n]), len(arrays[m])):
                    root[find(n)] = find(m)
                    links.append((names[n], names[m]))
        return _links_table(links)

    grouped = sets.select("id", "hashes").join(dealt, "id").groupBy("mixing", "least", "part")
    return checkpointed(grouped.applyInArrow(compare, _LINKS))


def _grouped(ranked: DataFrame, links: DataFrame) -> DataFrame:
    """``ranked`` with ``component`` and ``group``: the components of the links, in parts of about `GROUP` members alike in length."""
    labels = component_labels(links).toDF("id", "component")
    placed = ranked.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = placed.withColumn("band", F.floor(F.log("size") * 10))
    parts = placed.groupBy("component", "band").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    group = F.xxhash64("component", "band", part).alias("group")
    return checkpointed(placed.join(parts, ["component", "band"]).select(*ranked.columns, "component", group))


def _links_across(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """``(a, b)``: links between classes of different components, found by the token-group matrix."""
    index = F.explode(F.slice("probe", F.lit(1), F.col("index_length"))).alias("token")
    matrix = groups.select(index, "group", "component", "size", "covered").groupBy("token", "group", "component").agg(
        F.min("size").alias("least_size"), F.max("size").alias("greatest_size"), F.max("covered").alias("most_covered")
    )
    mine = groups.select(F.explode("probe").alias("token"), "id", "size", "covered", F.col("component").alias("own"))
    shorter = F.greatest(100 * F.col("least_size"), PERCENT * F.col("size"))  # hundredfold
    overlap = (100 + PERCENT) * 100 * F.least("covered", "most_covered") >= PERCENT * (100 * F.col("size") + shorter)
    sized = (F.col("least_size") <= F.col("size")) & (100 * F.col("greatest_size") >= PERCENT * F.col("size"))
    asked = checkpointed(mine.join(matrix, "token").filter("own <> component").filter(sized & overlap).select("group", "id").distinct())
    slices = checkpointed(asked.groupBy("group").agg(F.ceil(F.count("*") / SLICE_QUERIES).cast("int").alias("slices")))
    slice_ = F.pmod(F.xxhash64("id"), F.col("slices")).alias("slice")
    queries = asked.join(slices, "group").select("group", slice_, "id").join(sets.select("id", "hashes"), "id")
    every = F.explode(F.sequence(F.lit(0), F.col("slices").cast("long") - 1)).alias("slice")
    opened = groups.select("id", "group").join(slices, "group").select("group", every, "id")
    members = opened.join(sets.select("id", "hashes"), "id")

    def compare(asking: pa.Table, held: pa.Table) -> pa.Table:
        names = held.column("member").to_pylist()
        arrays = [_ascending(value) for value in held.column("tokens")]
        union = np.unique(np.concatenate(arrays)) if arrays else np.empty(0, np.int64)
        links = []
        for name, value in zip(asking.column("id").to_pylist(), asking.column("hashes")):
            tokens = _ascending(value)
            if 100 * _overlap(tokens, union) < PERCENT * len(tokens):
                continue
            for member, other in zip(names, arrays):
                if similar(_overlap(tokens, other), len(tokens), len(other)):
                    links.append((name, member))
        return _links_table(links)

    columns = ["group", "slice", "id", "hashes"]
    held = members.select(*columns).toDF("of_group", "of_slice", "member", "tokens")
    asking = queries.select(*columns).groupBy("group", "slice")
    return checkpointed(asking.cogroup(held.groupBy("of_group", "of_slice")).applyInArrow(compare, _LINKS))


def links(sets: DataFrame) -> DataFrame:
    """``(a, b)``: links of ``sets(id, size, hashes)``, enough of them to connect all that are similar."""
    ranked = _ranked(sets)
    within = _links_within(sets, ranked)
    return within.unionByName(_links_across(sets, _grouped(ranked, within)))


def join_similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` of each row."""
    rows, texts = _classes(df, id_col, text_col)
    classes = checkpointed(rows.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("least_id")))
    sets = candidate_sets(texts, classes)
    labels = component_labels(links(sets)).toDF("id", "root")
    linked = sets.select("id", "class").join(labels, "id").select("class", "root")
    named = linked.join(classes, "class").groupBy("root").agg(F.min("least_id").alias("named"))
    members = classes.join(linked, "class", "left").join(named, "root", "left")
    members = members.select("class", F.coalesce("named", "least_id").alias("component_id"))
    joined = rows.join(members, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))
