"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints: 64 bits by majority over the XXH64 values of word shingles.  Two of them
that differ in at most two bits agree within one bit on one 32-bit half.  On each half the
anchors are the words of the [31, 26] Hamming code (its 32nd bit is left out): the code is
perfect, so every half lies within covering radius 1 of exactly one anchor, its home.  A
half goes to every anchor within radius 1 + threshold 1 = 2 (at most 16), and members are
compared at their homes: if two halves are one bit apart, each of them reaches the other's home.

Texts with one fingerprint are one class before that.  An anchor with so many members that
comparing all pairs would grow with the square is dealt with by exact meeting points: each
member goes to itself and to the 64 points one bit away; two fingerprints lie within two
bits of each other if and only if they share such a point, and one edge a member to the
point's smallest one links them all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.linked import components
from ..shared import written
from . import textbuf as tb

#: An anchor whose homes times members are over this number is resolved by meeting points.
MOST_COMPARED = 4096
#: Parity checks of the Hamming code: check c covers the positions 1..31 whose bit c is set.
_CHECKS = [sum(1 << (p - 1) for p in range(1, 32) if p >> c & 1) for c in range(5)]


def _packed() -> np.ndarray:
    """For each byte, its 8 bits as 8 counters of one byte each, the lowest bit first."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view("<u8").ravel()


def _spoken(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first) of the words of each text between ASCII white space, A-Z in lower case, one space between them."""
    data, off = tb.flat(column)
    return tb.squeezed(tb.LOWER[data], off, tb.NOT_SPACE) if len(data) else (data, off[:0], off[:0], off)


def _runs(words, shingle: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all runs of `shingle` words, runs of each text that has words, these texts); a shorter text is one run."""
    data, starts, ends, first = words
    n = np.diff(first)
    has = np.flatnonzero(n)
    runs = np.maximum(n[has] - shingle + 1, 1)
    i = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs - first[has], runs)
    last = np.minimum(i + shingle - 1, np.repeat(first[has] + n[has] - 1, runs))
    return tb.xxh64(data, starts[i], ends[last], seed), runs, has


def fingerprints_of(column: pa.Array, shingle: int = 3) -> np.ndarray:
    """The fingerprint (uint64) of each text: A-Z in lower case, words between ASCII white space,
    runs of `shingle` words with repeats; a shorter text is one run, one without words is zero."""
    return _majority(*_runs(_spoken(column), shingle), len(column))


def _majority(h: np.ndarray, runs: np.ndarray, has: np.ndarray, texts: int) -> np.ndarray:
    """The bits that over half of each text's hashes have."""
    out = np.zeros(texts, np.uint64)
    if not len(has):
        return out
    base = np.cumsum(runs) - runs
    pieces = -(-runs // 255)
    piece = np.repeat(base, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    each = np.cumsum(pieces) - pieces
    ones = np.empty((len(has), 64), np.int64)
    packed = _packed()
    lanes = np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)
    for k in range(8):
        part = np.add.reduceat(packed[lanes[:, k]], piece)
        ones[:, 8 * k : 8 * k + 8] = np.add.reduceat(part.view(np.uint8).reshape(-1, 8).astype(np.int64), each, axis=0)
    bits = (2 * ones > runs[:, None]).astype(np.uint8)
    out[has] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): a row for each row of docs; fp holds the 64 bits as a long."""

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                fp = fingerprints_of(part.column("text"), shingle)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def _homes(half: Column) -> tuple[Column, Column]:
    """(syndrome, home anchor) of a 32-bit half held in a long."""
    s = F.lit(0)
    for c, mask in enumerate(_CHECKS):
        s = s + (F.bit_count(half.bitwiseAND(F.lit(mask))) % 2) * (1 << c)
    low = half.bitwiseAND(F.lit((1 << 31) - 1))
    return s, low


def _anchors(side: int, half: Column) -> Column:
    """All (key, home) structs of one half: its home, and the other anchors within two bits."""
    s, low = _homes(half)
    flip = lambda p: F.when(p == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), (p - 1).cast("int")))
    home = low.bitwiseXOR(flip(s))
    others = F.transform(
        F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: (s != 0) & (i.bitwiseXOR(s) > i)),
        lambda i: F.struct((low.bitwiseXOR(flip(i)).bitwiseXOR(flip(i.bitwiseXOR(s))) + F.lit(side << 32)).alias("key"), F.lit(False).alias("home")),
    )
    return F.concat(F.array(F.struct((home + F.lit(side << 32)).alias("key"), F.lit(True).alias("home"))), others)


def classes(prints: DataFrame) -> DataFrame:
    """(fp, rep): the distinct fingerprints, each with the smallest doc_id that has it."""
    return prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))


def _spread(df: DataFrame) -> DataFrame:
    """Rows of a small table over as many tasks as a shuffle has, before each becomes dozens."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def links(distinct: DataFrame, most_compared: int = MOST_COMPARED) -> DataFrame:
    """(a, b): edges between representatives whose components are those of all pairs within two bits."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.call_function("shiftrightunsigned", F.col("fp"), F.lit(32))
    dealt = written(_spread(distinct).select("fp", "rep", F.inline(F.concat(_anchors(0, low), _anchors(1, high)))), "dealt")
    size = dealt.groupBy("key").agg(F.count("*").alias("n"), F.count_if("home").alias("homes")).where("homes > 0 and n > 1")
    size = size.select("key", (F.col("n") * F.col("homes") > most_compared).alias("hot"))
    at = written(dealt.join(size, "key"), "anchors")
    x = at.where("home and not hot").select("key", F.col("fp").alias("fx"), F.col("rep").alias("a"))
    y = at.where("not hot").select("key", F.col("fp").alias("fy"), F.col("rep").alias("b"))
    close = F.bit_count(F.col("fx").bitwiseXOR(F.col("fy"))) <= 2
    compared = x.join(y, (x.key == y.key) & (x.a != y.b) & close).select("a", "b")
    crowd = at.where("hot").select("fp", "rep").distinct()
    one_off = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    meeting = crowd.select("rep", F.explode(F.concat(F.array("fp"), one_off)).alias("point"))
    first = meeting.groupBy("point").agg(F.min("rep").alias("b"), F.max("rep").alias("m")).where("m != b").select("point", "b")
    met = meeting.join(first, "point").where("rep != b").select(F.col("rep").alias("a"), "b")
    return compared.union(met)


def near_duplicates(docs: DataFrame, shingle: int = 3, most_compared: int = MOST_COMPARED) -> DataFrame:
    """(doc_id, fp, component): component is the smallest doc_id linked through fingerprints within two bits.

    Null and empty texts and those of white space have fingerprint zero and link like any other.
    Repeated doc_ids give repeated rows.  An empty table gives an empty result.  Other columns are ignored.
    """
    prints = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(classes(prints), "classes")
    comp = components(links(distinct, most_compared))
    of = distinct.join(comp, distinct.rep == comp.node, "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return prints.join(of, "fp").select("doc_id", "fp", "component")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs but those of documents in a near-duplicate group with a smaller doc_id.

    Rows with a null doc_id stay; rows that share a doc_id stay or go together.
    """
    gone = near_duplicates(docs.where("doc_id is not null"), **options).where("doc_id != component").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


#: Words of the runs behind the fingerprints by which similar() finds candidates: shorter ones than those that it compares,
#: since an edited word changes fewer of them and so fewer bits.
CANDIDATE_WORDS = 2
#: Candidates differ in this many bits of a fingerprint at most (texts of five-word Jaccard 0.8 have some 5, hardly ever over 13).
CANDIDATE_BITS = 16
#: An anchor with more members than this has each compared with its first and its most central one instead of with each other;
#: what these leave is found by rest().
PAIRED = 4
#: Similar texts share the first of their runs in any one order of all runs: this share of their runs, looked at beyond those that may differ.
FIRST_SHARE = 0.1


def _common(n, least: float):
    """Runs that texts with n of them share at least with a similar text."""
    return np.ceil(least * n - 1e-9).astype(np.int64)


def _shared_firsts(n, least: float):
    return np.minimum(np.maximum(np.ceil(FIRST_SHARE * n).astype(np.int64), 1), _common(n, least))


def _sets(words, shingle: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(the hash of each text's words, the sorted distinct hashes of its runs, these texts): of those that have words."""
    data, starts, ends, first = words
    h, runs, has = _runs(words, shingle)
    if not len(has):
        return np.zeros(0, np.int64), [], has
    body = tb.xxh64(data, starts[first[has]], ends[first[has + 1] - 1])
    return body.view(np.int64), [np.unique(x) for x in np.split(h.view(np.int64), np.cumsum(runs)[:-1])], has


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64()))


def _bodies(docs: DataFrame, shingle: int, least: float) -> DataFrame:
    """(doc_id, body, fa, fb, need, firsts): the hash of each text's words, and two fingerprints by other hashes of its runs.

    firsts are the runs with the smallest hashes: a similar text has `need` of them at least among its own firsts.  They are given
    with the first text of some words that a task meets, and are empty with the others.
    """

    def run(batches):
        met = set()
        for batch in batches:
            for part in tb.slices(batch, "text"):
                words = _spoken(part.column("text"))
                body, need, firsts = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64), [np.zeros(0, np.int64)] * part.num_rows
                some, sets, has = _sets(words, shingle)
                body[has] = some
                n = np.array([len(x) for x in sets], np.int64)
                need[has] = _shared_firsts(_common(n, least), least)
                ends = n - _common(n, least) + _shared_firsts(n, least)
                for k, b, x, end in zip(has.tolist(), some.tolist(), sets, ends.tolist(), strict=True):
                    if b not in met:
                        met.add(b)
                        firsts[k] = x[:end]
                fa, fb = (_majority(*_runs(words, CANDIDATE_WORDS, seed), part.num_rows) for seed in (42, 43))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *(pa.array(x.view(np.int64)) for x in (body, fa, fb, need)), _lists(firsts)], ["doc_id", "body", "fa", "fb", "need", "firsts"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, body long, fa long, fb long, need long, firsts array<long>")


def _shingles(docs: DataFrame, shingle: int) -> DataFrame:
    """(body, runs): the distinct hashes of the runs of each text that has words."""

    def run(batches):
        for batch in batches:
            for part in tb.slices(batch, "text"):
                body, sets, _ = _sets(_spoken(part.column("text")), shingle)
                yield pa.RecordBatch.from_arrays([pa.array(body), _lists(sets)], ["body", "runs"])

    return docs.select("text").mapInArrow(run, "body long, runs array<long>")


def _matchable(docs: DataFrame, prints: DataFrame, classes_: DataFrame, shingle: int, least: float) -> DataFrame:
    """(body, n, runs, firsts) of the texts that may have a similar one; all others have too many runs of their own.

    n is the number of a text's runs; runs are those that other such texts have too, the rarest first; firsts are the first of
    these, of which similar texts have one in common.
    """
    sent = prints.select("body", "need", F.explode("firsts").alias("run"))
    again = sent.groupBy("run").agg(F.min("body").alias("a"), F.max("body").alias("b")).where("a != b").select("run")
    shared = sent.join(again, "run", "left_semi").distinct().groupBy("body", "need").agg(F.count("*").alias("n")).where("n >= need")
    asked = written(classes_.join(shared, "body", "left_semi").select(F.col("rep").alias("doc_id")).distinct(), "asked")
    runs = written(_shingles(docs.join(asked, "doc_id", "left_semi"), shingle).groupBy("body").agg(F.first("runs").alias("runs")), "runs")
    each = runs.select("body", F.size("runs").alias("n"), F.explode("runs").alias("run"))
    often = each.groupBy("run").agg(F.count("*").alias("texts")).where("texts > 1")
    kept = each.join(often, "run").groupBy("body", "n").agg(F.transform(F.sort_array(F.collect_list(F.struct("texts", "run"))), lambda x: x["run"]).alias("runs"))
    spare = F.size("runs") - F.ceil(least * F.col("n") - 1e-9).cast("int")
    return written(kept.where(spare >= 0).select("body", "n", "runs", F.slice("runs", F.lit(1), spare + 1).alias("firsts")), "matchable")


def candidates(bodies: DataFrame, most_paired: int = PAIRED) -> DataFrame:
    """(x, y): pairs of bodies (body, fa, fb) that share an anchor on a half of a fingerprint and differ in few bits of the first.

    At an anchor with few members all are paired; at a crowded one each meets the first member and the one nearest to what most
    fingerprints have, so a group of copies of one text meets that text.  rest() has the pairs that this leaves out.
    """
    low, high = lambda c: F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)), lambda c: F.call_function("shiftrightunsigned", F.col(c), F.lit(32))
    places = F.concat(_anchors(0, low("fa")), _anchors(1, high("fa")), _anchors(2, low("fb")), _anchors(3, high("fb")))
    dealt = written(_spread(bodies).select("body", "fa", F.inline(places)).select("key", "body", "fa"), "dealt")
    size = dealt.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("body", "fa")).alias("first")).where("n > 1")
    met = written(dealt.join(size, "key"), "met")
    near = lambda c, d: F.bit_count(F.col(c).bitwiseXOR(F.col(d))) <= CANDIDATE_BITS
    few = met.where(F.col("n") <= most_paired)
    a = few.select("key", F.col("body").alias("x"), F.col("fa").alias("f"))
    b = few.select(F.col("key").alias("key_b"), F.col("body").alias("y"), F.col("fa").alias("g"))
    paired = a.join(b, (F.col("key") == F.col("key_b")) & (F.col("x") < F.col("y")) & near("f", "g")).select("x", "y")
    crowd = met.where(F.col("n") > most_paired)
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(k))
    votes = [F.when(2 * F.count_if(F.col("fa").bitwiseAND(bit(k)) != 0) > F.count("*"), bit(k)).otherwise(F.lit(0).cast("long")) for k in range(64)]
    usual = crowd.groupBy("key").agg(F.array(*votes).alias("bits")).select("key", F.aggregate("bits", F.lit(0).cast("long"), lambda x, y: x.bitwiseOR(y)).alias("usual"))
    off = F.bit_count(F.col("fa").bitwiseXOR(F.col("usual")))
    central = crowd.join(usual, "key").groupBy("key").agg(F.min(F.struct(off.alias("off"), "body", "fa")).alias("c"))
    star = lambda df, c: df.select(F.col("body").alias("x"), F.col("fa").alias("f"), F.col(f"{c}.body").alias("y"), F.col(f"{c}.fa").alias("g")).where((F.col("x") != F.col("y")) & near("f", "g")).select("x", "y")
    every = paired.union(star(crowd, "first")).union(star(crowd.join(central, "key"), "c"))
    return every.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _apart(matchable: DataFrame, sets: DataFrame) -> DataFrame:
    """(body, set, run, n, own, left): a row for each text and each of its firsts that texts of another set (body, set) have among theirs.

    own is the share of a text's runs that only it has, left the number of shared runs from this one on.
    """
    k = F.size("runs")
    at = matchable.join(sets, "body").select("body", "set", "n", (1 - k / F.col("n")).alias("own"), k.alias("k"), F.posexplode("firsts").alias("place", "run"))
    at = written(at.select("body", "set", "run", "n", "own", (F.col("k") - F.col("place")).alias("left")), "firsts")
    apart = at.groupBy("run").agg(F.min("set").alias("a"), F.max("set").alias("b")).where("a != b").select("run")
    return written(at.join(apart, "run", "left_semi"), "apart")


def _enough(least: float) -> Column:
    """Whether the runs from the first shared one on can do, for members x and y."""
    return (F.col("x.set") != F.col("y.set")) & ((1 + least) * F.least("x.left", "y.left") >= least * (F.col("x.n") + F.col("y.n")) - 1e-6)


def _centred(apart: DataFrame, least: float) -> DataFrame:
    """(x, y): each text with the text of the fewest runs of its own that shares a run."""
    centre = apart.groupBy("run").agg(F.min(F.struct("own", "body", "set", "n", "left")).alias("y"))
    return apart.alias("x").join(centre, "run").where(_enough(least)).select(F.least("x.body", "y.body").alias("x"), F.greatest("x.body", "y.body").alias("y")).distinct()


def rest(apart: DataFrame, least: float) -> DataFrame:
    """(x, y): pairs of texts of different sets, with all that are similar among them.

    Similar texts share one of their firsts, and the first one that they share leaves enough runs behind it in both.
    """
    met = apart.alias("x").join(apart.alias("y"), (F.col("x.run") == F.col("y.run")) & (F.col("x.body") < F.col("y.body")) & _enough(least))
    return met.select(F.col("x.body").alias("x"), F.col("y.body").alias("y")).distinct()


def _alike(pairs: DataFrame, matchable: DataFrame, least: float) -> DataFrame:
    """(a, b): the pairs whose sets of runs have the Jaccard similarity."""
    of = lambda c: matchable.select(F.col("body").alias(c), F.col("n").alias(f"n_{c}"), F.col("runs").alias(f"runs_{c}"))
    common = F.size(F.array_intersect("runs_x", "runs_y"))
    edges = pairs.join(of("x"), "x").join(of("y"), "y").select(F.col("x").alias("a"), F.col("y").alias("b"), common.alias("n"), (F.col("n_x") + F.col("n_y") - common).alias("of"))
    return edges.where(F.col("n") >= least * F.col("of")).select("a", "b")


def similar(docs: DataFrame, shingle: int = 5, least: float = 0.8, most_paired: int = PAIRED) -> DataFrame:
    """(doc_id, component): component is the smallest doc_id linked through texts whose sets of `shingle`-word runs have a Jaccard similarity of `least` or more.

    Exact.  Texts that have too many runs of their own for any partner are set aside; fingerprints and anchors link most of the others,
    texts meet the central one of those that share a rare run, and rest() finds every similar pair that is then in different sets.  Each pair is compared by its whole sets of runs.  Texts of
    the same words are one class before that; null, empty and white texts are one class too.  Rows with a null doc_id
    are left out; repeated doc_ids give repeated rows; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    prints = written(_bodies(docs, shingle, least), "bodies")
    classes_ = written(prints.groupBy("body").agg(F.min("doc_id").alias("rep"), F.min("fa").alias("fa"), F.min("fb").alias("fb")), "classes")
    matchable = _matchable(docs, prints, classes_, shingle, least)
    pairs = written(candidates(classes_.join(matchable, "body", "left_semi").select("body", "fa", "fb"), most_paired), "pairs")
    edges = written(_alike(pairs, matchable, least), "alike")
    for find in (_centred, rest):
        comp = components(edges)
        sets = matchable.join(comp, matchable.body == comp.node, "left").select("body", F.coalesce("component", "body").alias("set"))
        more = written(find(_apart(matchable, sets), least), find.__name__)
        edges = comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(written(_alike(more, matchable, least), "alike"))
    comp = components(edges)
    of = classes_.join(comp, classes_.body == comp.node, "left").select("body", "rep", F.coalesce("component", "body").alias("set"))
    of = written(of, "sets")
    first = of.groupBy("set").agg(F.min("rep").alias("component"))
    return prints.select("doc_id", "body").join(of.join(first, "set").select("body", "component"), "body").select("doc_id", "component")


def keep_one_similar(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs but those of documents with a similar one (see similar()) of a smaller doc_id in their group.

    Rows with a null doc_id stay; rows that share a doc_id stay or go together.
    """
    gone = similar(docs, **options).where("doc_id != component").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def op9_simhash_anchors(spark, sf_dir: str) -> DataFrame:
    """near_duplicates() of all documents: fingerprints in hex and component ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
