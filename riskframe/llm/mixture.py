"""Mixing sources to target weights with DataFrame expressions alone.

Every source is packed into blocks of ``block_words`` words, its documents end to end in key order.
The mix is a row of slots, one block each, cut into output shards. For every shard source counts are
drawn: each of its slots picks a source with the probability that its target gives (a multinomial
draw). Places drawn beyond a source's number of slots go, by index, to sources drawn too seldom, so
that the mix as a whole meets its targets exactly. The slots of a source are numbered through all
shards; slot number t falls into pass t / blocks over the source and there through a pseudorandom
permutation of its block numbers (swap-or-not rounds, which permute any range without retries). The
last, partial pass permutes the full blocks and cuts its last one to the words still missing. Slots
and blocks meet in an equi-join on source and block number. Nothing is kept in a driver loop.

Draws and permutations use arithmetic modulo 2**31 - 1 on 64-bit integers, so reruns, other layouts
and other engines give the same mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import free_name, running, with_row_ids, word_count
from riskframe.session import materialise, shuffle_width

PRIME = (1 << 31) - 1
#: Multipliers and increments of the mixing steps.
STEP_A, STEP_B, STEP_C, STEP_D = 48271, 1013904223, 69621, 1103515245
ROUNDS = 12


def mixed(*parts: Column) -> Column:
    """A number in [0, PRIME) from integers, by squaring modulo a prime."""
    h = F.lit(STEP_B).cast("bigint")
    for p in parts:
        h = (h * STEP_A + F.pmod(p.cast("bigint"), F.lit(PRIME))) % PRIME
        h = (h * h + STEP_C) % PRIME
    return h


def drawn(k: Column, total: Column | int, seed: int) -> Column:
    """A number in [0, total) for slot ``k``."""
    high, low = mixed(k, F.lit(seed)), mixed(k, F.lit(seed + 1))
    return (high * (1 << 31) + low) % (F.lit(total) if isinstance(total, int) else total)


def permuted(x: Column, n: Column, key: Column) -> Column:
    """Image of ``x`` under a permutation of [0, n) chosen by ``key``.

    Each round pairs every number with its mirror about a pivot and swaps the pair or not, as a bit
    of a hash of its larger member says.
    """

    def round_(x: Column, r: Column) -> Column:
        pivot = (F.pmod(key, F.lit(PRIME)) * STEP_A + r * STEP_C) % PRIME * STEP_D
        partner = F.pmod(pivot - x, n)
        draw = (F.greatest(x, partner) % PRIME * (pivot % 65521 + 1) + pivot) % PRIME
        return F.when(F.shiftright(draw, 14) % 2 == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x, round_)


@dataclass(frozen=True)
class Mixture:
    """Weights repeat over the sources in code point order, missing source last.

    ``share``: size of the mix as a share of all words; ``most``: how often a source may be taken.
    """

    weights: tuple = (5, 2, 1)
    share: float = 1.0
    most: int = 3
    block_words: int = 128
    shard_blocks: int = 8192
    seed: int = 42

    def sized(self, documents: DataFrame, key: str, text: str, source: str) -> DataFrame:
        """(doc_id, source, size, row) written once; ``row`` numbers the rows."""
        narrow = documents.select(
            F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")
        )
        return with_row_ids(narrow, "row", "sized")

    def targets(self, sized: DataFrame) -> DataFrame:
        """One row per source: s (its number), source, source_size, target, and the plan of its slots.

        Targets stop at ``most`` times the size; what a stop leaves over is shared by weight among
        the others until none is above. ``slots`` = ``passes`` over all ``blocks``, then ``rest``
        words from its ``full`` blocks (and the short last block where those don't suffice).
        """
        by_name = Window.orderBy(F.col("source").asc_nulls_last())
        cap = F.col("source_size") * self.most
        ratio = cap / F.col("w")
        by_ratio = Window.orderBy("ratio", "s")
        capped = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        weights = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
        every = Window.partitionBy()
        size, L = F.col("source_size"), self.block_words
        ranked = (
            sized.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("s", F.row_number().over(by_name).cast("bigint") - 1)
            .withColumn("w", F.element_at(F.array(*map(F.lit, self.weights)), (F.col("s") % len(self.weights) + 1).cast("int")).cast("double"))
            .withColumn("cap", cap).withColumn("ratio", ratio)
            .withColumn("all", F.sum("source_size").over(every) * F.lit(float(self.share)))
            .withColumn("level", (F.col("all") - capped) / weights)
            .withColumn("at", F.row_number().over(by_ratio))
            .withColumn("fits", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("at", "level"))).over(every)["level"])
            .withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce("fits", F.lit(float("inf"))) * F.col("w")))
        )
        words = F.least(F.floor("target").cast("bigint"), F.col("cap"))
        planned = (
            ranked.withColumn("words", words)
            .withColumn("passes", F.when(size > 0, F.expr("words div source_size")).otherwise(F.lit(0)))
            .withColumn("rest", F.col("words") - F.col("passes") * size)
            .withColumn("full", F.expr(f"source_size div {L}"))
            .withColumn("blocks", F.ceil(size / L).cast("bigint"))
            .withColumn("slots", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / L).cast("bigint"))
        )
        by_number = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        planned = planned.withColumn("begin", F.coalesce(F.sum("slots").over(by_number), F.lit(0)))
        columns = "s source source_size target passes rest full blocks slots begin".split()
        return materialise(planned.select(columns), "targets")

    def slots(self, targets: DataFrame) -> DataFrame:
        """(shard, s, t): which slots of which source each output shard holds."""
        spark = targets.sparkSession
        total, n = targets.agg(F.sum("slots"), F.count(F.lit(1))).first()
        total = total or 0
        wide = max(1, total // (4 * max(n, 1)))  # ranges of the number line, about four a source
        lots = materialise(
            targets.where("slots > 0").select(
                "s", "begin", (F.col("begin") + F.col("slots")).alias("until"),
                F.explode(F.sequence(F.expr(f"begin div {wide}"), F.expr(f"(begin + slots - 1) div {wide}"))).alias("lot"),
            ),
            "lots",
        )
        picks = spark.range(total).select(
            F.expr(f"id div {self.shard_blocks}").alias("shard"), drawn(F.col("id"), max(total, 1), self.seed).alias("p")
        ).withColumn("lot", F.expr(f"p div {wide}"))
        counts = (
            picks.join(lots, (picks["lot"] == lots["lot"]) & (F.col("p") >= F.col("begin")) & (F.col("p") < F.col("until")))
            .groupBy("shard", "s").agg(F.count(F.lit(1)).alias("n"))
        )
        counts = running(materialise(counts, "draws"), "s", [F.col("shard")], "n", "first", "slots")
        limits = targets.select("s", "slots")
        dealt = materialise(
            counts.join(limits, "s").withColumn("kept", F.greatest(F.lit(0), F.least("n", F.col("slots") - F.col("first")))),
            "dealt",
        )
        kept = dealt.where("kept > 0").repartition(shuffle_width(spark), "shard", "s").select(
            "shard", "s", F.explode(F.expr("sequence(first, first + kept - 1)")).alias("t")
        )
        one = F.lit(0).alias("one")
        free = dealt.groupBy("shard").agg(F.sum(F.col("n") - F.col("kept")).alias("n")).where("n > 0").select("shard", "n", one)
        free = running(free, "one", [F.col("shard")], "n", "first", "free").select(
            "shard", F.explode(F.expr("sequence(first, first + n - 1)")).alias("i")
        )
        drawn_by = dealt.groupBy("s").agg(F.sum("kept").alias("have"))
        short = limits.join(drawn_by, "s", "left").withColumn("have", F.coalesce("have", F.lit(0)))
        short = short.where("have < slots").withColumn("n", F.col("slots") - F.col("have")).withColumn("one", F.lit(0))
        short = running(short, "one", [F.col("s")], "n", "first", "short").select(
            "s", F.posexplode(F.expr("sequence(have, slots - 1)")).alias("j", "t"), "first"
        ).withColumn("i", F.col("first") + F.col("j"))
        return kept.unionByName(free.join(short, "i").select("shard", "s", "t"))

    def placed(self, targets: DataFrame) -> DataFrame:
        """The mix: (shard, s, t, pass, block, cut); ``cut`` is NULL or the words taken of a block."""
        L = self.block_words
        late = F.col("t") >= F.col("passes") * F.col("blocks")
        j = F.col("t") - F.col("passes") * F.col("blocks")
        narrow = targets.select("s", "passes", "rest", "full", "blocks")
        return (
            self.slots(targets).join(narrow, "s")
            .withColumn("pass", F.when(late, F.col("passes")).otherwise(F.expr("t div blocks")))
            .withColumn("x", F.when(late, j).otherwise(F.col("t") % F.col("blocks")))
            .withColumn("n", F.when(late, F.col("full")).otherwise(F.col("blocks")))
            .withColumn("key", (F.col("s") * 1009 + F.col("pass")) * 31 + self.seed)
            .withColumn("block", F.when(F.col("x") >= F.col("n"), F.col("x")).otherwise(permuted(F.col("x"), F.col("n"), F.col("key"))))
            .withColumn("cut", F.when(late & (F.col("rest") - j * L < L), F.col("rest") - j * L))
            .select("shard", "s", "t", "pass", "block", "cut")
        )

    def pieces(self, sized: DataFrame, targets: DataFrame) -> DataFrame:
        """(row, doc_id, s, size, block, lo, hi, word): part of each document in each block it meets.

        ``lo`` and ``hi`` count words inside the block, ``word`` is the part's first word in the
        document. Documents without words have one row with ``block`` NULL.
        """
        L = self.block_words
        named = sized.join(targets.select("s", F.col("source").alias("_of")), F.col("source").eqNullSafe(F.col("_of")))
        at = running(
            named.select("row", "doc_id", "s", "size"), "s", [F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("row")],
            "size", "at", "packed",
        )
        met = F.when(F.col("size") > 0, F.sequence(F.expr(f"at div {L}"), F.expr(f"(at + size - 1) div {L}")))
        return (
            at.withColumn("block", F.explode_outer(met))
            .withColumn("lo", F.greatest(F.lit(0), F.col("at") - F.col("block") * L))
            .withColumn("hi", F.least(F.lit(L), F.col("at") + F.col("size") - F.col("block") * L))
            .withColumn("word", F.col("block") * L + F.col("lo") - F.col("at"))
        )

    def report(self, documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
        """Per document: key, size, source_size, target (its source's), taken (words in the mix).

        Defined results: missing and empty texts have size 0 and are not taken, a missing source is
        a source of its own, repeated rows are documents of their own, documents without a key come
        last in their source; an empty table gives an empty result.
        """
        sized = self.sized(documents, key, text, source)
        targets = self.targets(sized)
        used = (
            self.placed(targets).groupBy("s", "block")
            .agg(F.sum(F.col("cut").isNull().cast("bigint")).alias("whole"), F.max(F.coalesce("cut", F.lit(0))).alias("cut"))
        )
        part = F.col("whole") * (F.col("hi") - F.col("lo")) + F.greatest(F.lit(0), F.least("hi", "cut") - F.col("lo"))
        taken = (
            self.pieces(sized, targets).join(used, ["s", "block"], "left")
            .groupBy("row", "doc_id", "s", "size").agg(F.sum(F.coalesce(part, F.lit(0))).cast("bigint").alias("taken"))
        )
        return taken.join(targets.select("s", "source_size", "target"), "s").select(
            F.col("doc_id").alias(key), "size", "source_size", "target", "taken"
        )

    def blocks(self, documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
        """The mixed blocks themselves: shard, s, t, block, text (its words joined by blanks)."""
        marked, sized, number = self._marked(documents, key, text, source)
        targets = self.targets(sized)
        words = marked.select(F.col(number).alias("_mixrow"), F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), "").alias("words"))
        packed = (
            self.pieces(sized, targets).where("block IS NOT NULL").join(words, F.col("row") == F.col("_mixrow"))
            .select("s", "block", "lo", F.slice("words", F.col("word").cast("int") + 1, (F.col("hi") - F.col("lo")).cast("int")).alias("part"))
            .groupBy("s", "block").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("lo", "part"))), lambda p: p["part"])).alias("words"))
        )
        cut = F.coalesce(F.col("cut"), F.lit(self.block_words)).cast("int")
        return self.placed(targets).join(packed, ["s", "block"]).select(
            "shard", "s", "t", "block", F.array_join(F.slice("words", F.lit(1), cut), " ").alias("text")
        )

    def _marked(self, documents: DataFrame, key: str, text: str, source: str):
        """(rows with a number, their sizes, the name of the number)."""
        number = free_name(documents, "_mixrow")
        marked = with_row_ids(documents, number, "marked")
        sized = materialise(
            marked.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.col(number).alias("row")),
            "sized",
        )
        return marked, sized, number

    def documents(
        self, documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", length: str = "n_chars"
    ) -> DataFrame:
        """The mix as documents: one row per document and pass that takes words of it.

        A document taken whole keeps its text; otherwise the text holds the words taken, parts of
        different blocks on lines of their own, and ``length`` its characters. Other columns stay.
        """
        marked, sized, number = self._marked(documents, key, text, source)
        targets = self.targets(sized)
        taken = (
            self.pieces(sized, targets).where("block IS NOT NULL").join(self.placed(targets), ["s", "block"])
            .withColumn("n", F.least("hi", F.coalesce("cut", "hi")) - F.col("lo")).where("n > 0")
            .groupBy("row", "pass", "size")
            .agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct(F.col("word").cast("int").alias("word"), F.col("n").cast("int").alias("n")))).alias("parts"))
            .select(F.col("row").alias(number), F.when(F.col("n") < F.col("size"), F.col("parts")).alias("parts"))
        )
        # beside the columns of the table, whatever their names are
        parts, words, new = (free_name(marked, c) for c in ("_parts", "_words", "_text"))
        split = F.array_remove(F.split(F.col(text), r"[\x20\x09-\x0D]+"), "")
        lines = F.transform(F.col(parts), lambda p: F.array_join(F.slice(F.col(words), p["word"] + 1, p["n"]), " "))
        whole = F.col(parts).isNull()
        joined = (
            marked.join(taken.withColumnRenamed("parts", parts), number)
            .withColumn(words, F.when(~whole, split))
            .withColumn(new, F.when(whole, F.col(text)).otherwise(F.array_join(lines, "\n")))
        )
        changed = {text: F.col(new), length: F.when(whole, F.col(length)).otherwise(F.length(new))}
        return joined.select(*[(changed[c].cast(kind) if c in changed else F.col(f"`{c}`")).alias(c) for c, kind in documents.dtypes])
