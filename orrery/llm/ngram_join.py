"""N-gram Jaccard join by filters under several global token orders.

Tokens are 64-bit hashes of word n-grams (a chain of mixes over the words' hashes). A document of n tokens can only reach the threshold num/den with
another if the two share a token among the first k = n - ceil(num*n/den) + 1 tokens of *any* order
that all documents use. Three orders are used, cheapest first, and a pair has to pass all of them
before its sets are compared:

1. by hash value. Here the prefix is longer by e = k//2 tokens, of which at least 1 + e of the
   smallest possible partner have to be shared with anyone, so a document drops out without any
   pair being made when too few of its prefix tokens occur elsewhere;
2. by document frequency, rarest first, over what is left: tokens that occur in one document come
   first and can't be shared, so lists of frequent passages are never paired;
3. by a second hash.

Exact copies collapse before all of this. Pairs are made in two steps: every document against the
least mutated members of its posting lists, then, for what is still in different components, each
remaining pair once, at its first shared prefix token. Components are found by distributed rounds.

Defined results: null or blank text has no tokens, n_shingles 0 and links with nothing; fewer words
than n make one token; rows with a null id are left out; rows that repeat an id are one document, that
of the fewest tokens (ties by digest); other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orrery.llm.shared import Components, Workspace, few, keep_ids
from orrery.llm.wordhash import U, chunks, mix


def _sets(words, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct tokens of each row."""
    grams, bounds = words.grams(n)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        x = np.sort(grams[lo:hi])
        if hi - lo > 1:
            x = x[np.concatenate(([True], x[1:] != x[:-1]))]
        yield x


def prefix_length(n: int, num: int, den: int) -> int:
    """Tokens of which one at least is shared with any partner, under any order."""
    return n - -(-num * n // den) + 1


def _digests(sets) -> list[pa.Array]:
    """Size and two 64-bit digests of each set."""
    rows = [(len(x), int(mix(x).sum(dtype=U)), int(mix(x ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=U))) for x in sets]
    size, d1, d2 = (np.array(v, dtype=t) for v, t in zip(zip(*rows), (np.int64, U, U)))
    return [pa.array(size), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))]


def _profile(n: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, words in chunks(batch, True):
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi].astype(np.int64)), *_digests(_sets(words, n))], names=["doc_id", "n", "d1", "d2"])

    return run


def _hash_prefix(n: int, num: int, den: int):
    """Rows (token, key, spare): of each token one row a batch, key null if several documents of the batch hold it.

    One row a document (spare not null) holds how many prefix tokens such batches found shared, less those needed.
    """

    def extra(k: int) -> int:
        return k // 2

    def need(size: int) -> int:
        least = -(-num * size // den)  # the smallest partner has the smallest excess
        return 1 + min(extra(prefix_length(least, num, den)), extra(prefix_length(size, num, den)))

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            tokens, owner, needed = [], [], np.zeros(len(ids), np.int64)
            for lo, _, words in chunks(batch, True):
                for i, x in enumerate(_sets(words, n), lo):
                    if size := len(x):
                        k = prefix_length(size, num, den)
                        tokens.append(x[: k + extra(k)])
                        owner.append(np.full(len(tokens[-1]), i))
                        needed[i] = need(size)
            if not tokens:
                continue
            t, o = np.concatenate(tokens), np.concatenate(owner)
            del tokens, owner
            order = np.argsort(t, kind="stable")
            t, o = t[order], o[order]
            head = np.concatenate(([True], t[1:] != t[:-1]))
            several = np.concatenate((t[1:] == t[:-1], [False]))[head]
            local = np.bincount(o[~(head & np.concatenate((t[1:] != t[:-1], [True])))], minlength=len(ids))
            have = np.flatnonzero(needed)
            token = np.concatenate((t[head], mix(ids[have].view(U) ^ U(0x5851F42D4C957F2D)))).view(np.int64)
            key = np.concatenate((ids[o[head]], ids[have]))
            none = np.concatenate((several, np.zeros(len(have), bool)))
            spare = np.concatenate((np.zeros(int(head.sum()), np.int32), (local - needed)[have].astype(np.int32)))
            blank = np.concatenate((np.ones(int(head.sum()), bool), np.zeros(len(have), bool)))
            out = [pa.array(token), pa.array(key, mask=none), pa.array(spare, mask=blank)]
            for at in range(0, len(token), 100_000):
                yield pa.RecordBatch.from_arrays([x.slice(at, 100_000) for x in out], names=["token", "key", "spare"])

    return run


def _token_sets(n: int, num: int, den: int):
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for lo, hi, words in chunks(batch, True):
                sets = list(_sets(words, n))
                second = [np.sort(mix(x ^ U(0xC2B2AE3D27D4EB4F)))[: prefix_length(len(x), num, den)] if len(x) else x for x in sets]
                lists = [pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum([len(x) for x in part]))).astype(np.int32), np.concatenate(part).view(np.int64)) for part in (sets, second)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[lo:hi]), *_digests(sets), *lists], names=["doc_id", "n", "d1", "d2", "tokens", "second"])

    return run


def ngram_jaccard_components(
    docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: links are den * |intersection| >= num * |union|."""
    spark = docs.sparkSession
    ws = Workspace(spark, "ngram")
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")).where("doc_id is not null")

    members = docs.mapInArrow(_profile(words), "doc_id long, n long, d1 long, d2 long")
    members = members.groupBy("doc_id").agg(F.min(F.struct("n", "d1", "d2")).alias("s"), F.count("*").alias("times"))
    members = ws.save(members.select("doc_id", "s.*", "times"), "members")
    same = ["n", "d1", "d2"]
    shared = ws.save(members.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1").drop("copies"), "shared")
    copies = ws.save(members.join(few(shared), same).where("doc_id <> rep").select("doc_id", "rep"), "copies")
    first = keep_ids(docs, copies, "doc_id", "left_anti")

    # order 1: hash values; documents only
    held = first.mapInArrow(_hash_prefix(words, num, den), "token long, key long, spare int")
    held = held.withColumn("times", F.count("*").over(Window.partitionBy("token")))
    held = held.where("spare is not null or (key is not null and times > 1)")
    alive = held.groupBy("key").agg(F.sum(F.coalesce("spare", F.lit(1))).alias("spare")).where("spare >= 0")
    alive = ws.save(alive.select(F.col("key").alias("doc_id")), "alive")
    sets = keep_ids(first, alive, "doc_id").mapInArrow(_token_sets(words, num, den), "doc_id long, n long, d1 long, d2 long, tokens array<long>, second array<long>")
    if members.where("times > 1").limit(1).count():  # ids that several rows have: the one whose digests were taken
        sets = sets.join(members.select("doc_id", *same), ["doc_id", *same], "left_semi").dropDuplicates(["doc_id"])
    sets = ws.save(sets.drop("d1", "d2"), "sets")

    # order 2: document frequency, rarest first
    each = sets.select(F.col("doc_id").alias("rep"), "n", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    own = Window.partitionBy("rep")
    least = F.expr(f"(n * {num} + {den - 1}) div {den}")
    post = (
        each.join(often, "token")
        .withColumn("s", F.count("*").over(own))
        .withColumn("place", F.row_number().over(own.orderBy("df", "token")))
        .where((F.col("s") * den >= F.col("n") * num) & (F.col("place") <= F.col("n") - least + 1 - (F.col("n") - F.col("s"))))
        .select("token", "rep", "n", "s", "place")
    )
    post = ws.save(post, "post")

    def fits(a: str, b: str, first: bool = False):
        """Whether sizes and the numbers of tokens that anyone shares allow the threshold.

        first: the token at hand is the first that the two share, so none before it counts.
        """
        common = F.least(*[F.expr(f"{x}.s - {x}.place + 1") if first else F.col(f"{x}.s") for x in (a, b)])
        return common * den >= (F.col(f"{a}.n") + F.col(f"{b}.n") - common) * num

    def prefix(x: str):
        return F.slice(f"{x}.tokens", F.lit(1), F.expr(f"int({x}.n - (({x}.n * {num} + {den - 1}) div {den}) + 1)"))

    def linked(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that share prefix tokens under the two hash orders as well, and then reach the threshold."""
        y = pairs.join(sets.select(F.col("doc_id").alias("b"), F.struct("n", "tokens", "second").alias("y")), "b")
        both = y.join(sets.select(F.col("doc_id").alias("a"), F.struct("n", "tokens", "second").alias("x")), "a")
        both = both.where(F.arrays_overlap("x.second", "y.second") & F.arrays_overlap(prefix("x"), prefix("y")))
        common = F.size(F.array_intersect("x.tokens", "y.tokens"))
        return both.where(common * den >= (F.col("x.n") + F.col("y.n") - common) * num).select("a", "b")

    # step 1: each document against the three leaders that most of its lists name
    lead = post.groupBy("token").agg(F.min(F.struct((F.col("n") - F.col("s")).alias("u"), "rep", "n", "s")).alias("x"), F.count("*").alias("size")).where("size > 1").select("token", "x")
    vote = post.alias("y").join(lead, "token").where((F.col("y.rep") != F.col("x.rep")) & fits("x", "y"))
    vote = vote.groupBy(F.col("y.rep").alias("b"), F.col("x.rep").alias("a")).count()
    vote = vote.withColumn("best", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("count"), "a"))).where("best <= 3")
    links = ws.save(linked(vote.select("a", "b")), "links-1")
    groups = Components(ws)
    groups.add(links)
    ws.drop("links-1")

    # step 2: what is left between different components
    here = post.join(few(groups.labels.withColumnRenamed("v", "rep")), "rep", "left").withColumn("component", F.coalesce("c", "rep")).drop("c")
    open_ = here.groupBy("token").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d").select("token")
    here = here.join(open_, "token", "left_semi")
    signs = F.array_sort(F.collect_list(F.struct("place", "token")).over(own))
    here = ws.save(here.withColumn("signs", F.transform(signs, lambda t: t["token"])), "open")
    x, y = here.alias("x"), here.alias("y")
    rest = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.rep") < F.col("y.rep"))
        & (F.col("x.component") != F.col("y.component"))
        & fits("x", "y", first=True)
        & (F.element_at(F.array_intersect("x.signs", "y.signs"), 1) == F.col("x.token")),
    ).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    if here.limit(1).count():
        groups.add(ws.save(linked(rest), "links-2"))

    out = members.join(few(copies), "doc_id", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    out = out.join(few(groups.labels.withColumnRenamed("v", "rep")), "rep", "left")
    out = ws.save(out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "rep").alias("component_id")), "out")
    ws.keep_only("out")
    return out
