"""Activity-code sets and the most-similar-customer operator.

score(prospect P, customer R) = |codes(P) & codes(R)| / |codes(R)|, the share
of the customer's codes the prospect also has. Each prospect gets the
customer with the highest score; ties go to the smallest customer id; a
prospect sharing no code gets (NULL, 0.0).

One exact plan at every size, without a cross product:

* Codes are numbered once (a classification, some 1,300 in the registry), so a
  company's code set is a bit set: an array of 64-bit words, as wide as the
  classification needs, whatever the set holds. The overlap of two sets is
  ``bit_count`` of their words' conjunction.
* Every company's set is written once to the shared folder (cuts the lineage,
  survives lost executors). Equal sets are scored once, for the smallest id of
  the set on either side: a prospect's score depends on its set only, and a
  customer with the set of a smaller id never wins. The groups are combined
  map-side, so a set of a third of all companies is one row per task.
* Lower bound: per code, the customer set with the fewest codes among those
  holding it. A prospect set meets one such set per code it holds; the best
  of their exact scores, k0 / n0, is a score it really reaches.
* Only customers that can still reach the bound are joined. Codes are numbered
  from the rarest, those no prospect holds counting first; if the code at position i (of
  n, from 0) is the first one shared, at most n - i are shared. The equi-join
  on the code therefore keeps (n - i) / n >= k0 / n0 and |P| / n >= k0 / n0
  (length bound), compared as whole numbers, and only if no code in front of
  it is shared: a pair is formed once. A frequent code stands last in
  its sets, so it forms pairs only where nothing rarer is shared.
* The join's work grows with the pairs it forms, not with the bytes it reads, so
  customer sets are dealt over a number of tasks of their own (AQE would merge
  them by bytes) and index rows that no prospect of their code can use are
  dropped before it. Few prospect sets are broadcast; otherwise a code is
  dealt by code and customer, so that no task holds a whole hot code. Scores are
  reduced to one row per prospect set map-side, before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketscope.functions import split_codes
from marketscope.session import shared_dir


def explode_codes(estabelecimento: DataFrame, column: str = "cnae_fiscal_secundaria") -> DataFrame:
    """G1: one row per listed code; an empty list gives no row, elements are not trimmed."""
    return (estabelecimento.where(F.col(column) != "")
            .select("cnpj", F.explode(split_codes(column)).alias(column)))


def company_codes(fact: DataFrame, secondary: DataFrame) -> DataFrame:
    """Distinct (cnpj, code) of fact companies: primary plus secondary.

    ``secondary`` is the exploded table (cnpj, cnae_fiscal_secundaria).
    Duplicates are dropped map-side before the shuffle, so repeated rows of
    one company never pile up in one task.
    """
    keys = fact.select("cnpj").distinct()
    primary = fact.where(F.col("cnae_fiscal").isNotNull()).select("cnpj", F.col("cnae_fiscal").alias("code"))
    extra = (secondary.where(F.col("cnae_fiscal_secundaria").isNotNull())
             .join(keys, "cnpj", "left_semi")
             .select("cnpj", F.col("cnae_fiscal_secundaria").alias("code")))
    return primary.unionByName(extra).distinct()


def code_signature(codes: DataFrame) -> DataFrame:
    """Sorted distinct code list per company: (cnpj, codigos, n_codigos)."""
    return codes.groupBy("cnpj").agg(
        F.array_join(F.array_sort(F.collect_set("code")), ",").alias("codigos"),
        F.count(F.lit(1)).cast("bigint").alias("n_codigos"))


#: customer sets a task pairs, about
SETS_PER_TASK = 20_000
#: rows of exploded prospect sets up to which they are broadcast
BROADCAST_ROWS = 200_000
#: tasks that share a code's customer sets where the prospect sets are not broadcast
SALTS = 16


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def code_numbers(codes: DataFrame) -> DataFrame:
    """(code, no): the codes in use, numbered from 0 from the rarest, ties by code; written once.

    One task numbers them: a classification's codes, not companies.
    """
    used = codes.where(F.col("code").isNotNull()).groupBy("code").agg(F.count(F.lit(1)).alias("rows"))
    numbered = used.select("code", (F.row_number().over(Window.orderBy("rows", "code")) - 1).alias("no"))
    return _written(numbered, "similarity_codes")


def bit_set(numbers: str, width: int) -> Column:
    """Array of ``width`` 64-bit words with a bit for each of an array column's numbers."""
    words = [f"aggregate(filter({numbers}, c -> c div 64 = {w}), 0L, (a, c) -> a | shiftleft(1L, c % 64))" for w in range(width)]
    return F.expr(f"array({', '.join(words)})")


def overlap(one: str, other: str, width: int) -> Column:
    """How many bits two bit sets of ``width`` words share (one compiled expression, no loop)."""
    shared = [F.bit_count(F.col(one)[w].bitwiseAND(F.col(other)[w])) for w in range(width)]
    return reduce(Column.__add__, shared).cast("bigint")


def width_of(sets: DataFrame) -> int:
    """Words of the bit sets of a written table."""
    row = sets.select(F.size("bits")).first()
    return row[0] if row else 1


def _code_sets(codes: DataFrame, clients: DataFrame, prospects: DataFrame) -> DataFrame:
    """(cnpj, is_client, numbers, bits, n): the distinct codes of every company with a role, written once."""
    roles = (clients.select("cnpj").distinct().withColumn("is_client", F.lit(True))
             .unionByName(prospects.select("cnpj").distinct().withColumn("is_client", F.lit(False))))
    known = code_numbers(codes)
    width = max(1, -(-known.count() // 64))
    sets = (codes.join(known, "code").groupBy("cnpj").agg(F.array_sort(F.collect_set("no")).alias("numbers"))
            .join(roles, "cnpj")
            .select("cnpj", "is_client", "numbers", bit_set("numbers", width).alias("bits"), F.size("numbers").cast("bigint").alias("n")))
    return _written(sets, "similarity_sets")


def _distinct_sets(sets: DataFrame, is_client: bool, rep: str, prefix: str, n: str) -> DataFrame:
    """One row per code set of one side; its smallest company id stands for it."""
    side = sets.where(F.col("is_client") == is_client)
    return (side.groupBy(F.col("bits").alias(f"{prefix}_bits"), F.col("n").alias(n))
            .agg(F.min("cnpj").alias(rep), F.first("numbers").alias(f"{prefix}_numbers")))      # equal bits, equal numbers


def _score(k: Column, n: Column) -> Column:
    return k.cast("double") / n.cast("double")


def _first(score: Column, *rest: Column) -> Column:
    """Aggregate: the highest score, then the smallest ``rest`` (max_by would break ties arbitrarily)."""
    return F.min(F.struct((-score).alias("neg"), *rest))


def _spread(clients: DataFrame) -> DataFrame:
    """Customer sets over a fixed number of tasks, by their count."""
    tasks = max(2 * clients.sparkSession.sparkContext.defaultParallelism, -(-clients.count() // SETS_PER_TASK))
    return clients.repartition(tasks, "cliente")


def _lower(no: str, word: int) -> Column:
    """The bits of a bit set's word that stand for numbers below ``no``."""
    n = F.col(no)
    ones = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), n - 64 * word))
    return F.when(n >= 64 * (word + 1), F.lit(-1).cast("bigint")).when(n < 64 * word, F.lit(0).cast("bigint")).otherwise(ones)


def client_index(clients: DataFrame, prospects: DataFrame) -> DataFrame:
    """(no, i, cliente, client_bits, before, n): every code of every customer set that a prospect set holds.

    ``i`` counts the customer's codes that come before it: those no prospect holds, then from the rarest.
    ``before`` holds the bits of the codes in front of it. All from the bit sets: customers stay where they are.
    """
    first = clients.select(F.size("client_bits")).first()
    width = first[0] if first else 1
    held = prospects.agg(F.array(*[F.bit_or(F.col("prospect_bits")[w]) for w in range(width)]).alias("held")).scalar()
    rows = (_spread(clients).select("cliente", "client_bits", "n", held.alias("held"), F.explode("client_numbers").alias("no"))
            .withColumn("before", F.array(*[F.col("client_bits")[w].bitwiseAND(_lower("no", w)) for w in range(width)])))
    i = F.col("n") - overlap("client_bits", "held", width) + overlap("before", "held", width)
    return (rows.where(F.get("held", (F.col("no") / 64).cast("int"))
                       .bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("no") % 64)) != 0)
            .select("no", i.alias("i"), "cliente", "client_bits", "before", "n"))


def lower_bounds(prospects: DataFrame, index: DataFrame, width: int) -> DataFrame:
    """(rep, k0, n0): a score every prospect set reaches, from one customer set per code.

    The fewest codes per code are found first, as numbers; then only the sets with so few are compared by id.
    """
    least = index.groupBy("no").agg(F.min("n").alias("n"))               # a row per code of the classification
    fewest = (index.join(F.broadcast(least), ["no", "n"]).groupBy("no").agg(F.min(F.struct("n", "cliente", "client_bits")).alias("c"))
              .select("no", "c.n", "c.client_bits"))
    return (prospects.select("rep", "prospect_bits", F.explode("prospect_numbers").alias("no")).join(F.broadcast(fewest), "no")
            .select("rep", "n", overlap("prospect_bits", "client_bits", width).alias("k"))
            .groupBy("rep").agg(_first(_score(F.col("k"), F.col("n")), F.col("k"), F.col("n")).alias("b"))
            .select("rep", F.col("b.k").alias("k0"), F.col("b.n").alias("n0")))


def _meet(prospects: DataFrame, index: DataFrame, width: int, more: Column | None = None) -> DataFrame:
    """Every prospect set with every customer set it shares a code with, once: at their rarest shared code.

    ``prospects``: a row per set and code (no), with prospect_bits; ``more`` is a further condition.
    """
    met = overlap("prospect_bits", "before", width) == 0
    if more is not None:
        met = met & more
    if prospects.count() <= BROADCAST_ROWS:
        return index.join(F.broadcast(prospects), "no").where(met)
    spark = index.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    dealt = index.withColumn("salt", F.pmod(F.xxhash64("cliente"), F.lit(SALTS)).cast("int")).repartition(tasks, "no", "salt")
    copies = prospects.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).repartition(tasks, "no", "salt")
    return dealt.join(copies, ["no", "salt"]).where(met)


def candidates(prospects: DataFrame, index: DataFrame, width: int) -> DataFrame:
    """(rep, cliente, k, n) of every pair of sets that may reach the prospect set's lower bound, each once (at its rarest shared code)."""
    bounds = _written(lower_bounds(prospects, index, width), "similarity_bounds")
    bounded = (prospects.join(bounds, "rep")
               .select("rep", "prospect_bits", "n_prospect", "k0", "n0", F.explode("prospect_numbers").alias("no")))
    # the lowest bound of a code's prospects, a little lower for rounding: what stays below it meets none of them
    floors = bounded.groupBy("no").agg((F.min(_score(F.col("k0"), F.col("n0"))) - 1e-9).alias("floor"))
    reachable = (index.join(F.broadcast(floors), "no")
                 .where((F.col("n") - F.col("i")).cast("double") >= F.col("floor") * F.col("n")).drop("floor"))
    can_reach = (((F.col("n") - F.col("i")) * F.col("n0") >= F.col("k0") * F.col("n"))
                 & (F.col("n_prospect") * F.col("n0") >= F.col("k0") * F.col("n")))
    return (_meet(bounded, reachable, width, can_reach)
            .select("rep", "cliente", "n", overlap("prospect_bits", "client_bits", width).alias("k")))


def _sides(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct sets of the prospects and of the customers, written once."""
    return (_written(_distinct_sets(sets, False, "rep", "prospect", "n_prospect"), "similarity_prospects"),
            _written(_distinct_sets(sets, True, "cliente", "client", "n"), "similarity_clients"))


def similarity_pairs(codes: DataFrame, clients: DataFrame, prospects: DataFrame) -> DataFrame:
    """The pairs of different code sets that share a code, with overlap and score.

    Columns: cnpj, cliente (smallest id of the prospects and of the customers
    with the set), intersecao, n_cliente, similaridade. Companies of one set
    have the same scores: with :func:`set_members` no link is lost and copies are not expanded.
    """
    sets = _code_sets(codes, clients, prospects)
    p, c = _sides(sets)
    width = width_of(sets)
    held = p.select("rep", "prospect_bits", F.explode("prospect_numbers").alias("no"))
    pairs = _meet(held, client_index(c, p), width).select("rep", "cliente", "n", overlap("prospect_bits", "client_bits", width).alias("k"))
    return pairs.select(F.col("rep").alias("cnpj"), "cliente", F.col("k").alias("intersecao"), F.col("n").alias("n_cliente"),
                        _score(F.col("k"), F.col("n")).alias("similaridade"))


def set_members(codes: DataFrame, clients: DataFrame, prospects: DataFrame) -> DataFrame:
    """(cnpj, representante, cliente, n_codigos): the representative of every company's code set on its side.

    The links of a company are those of its representative in :func:`similarity_pairs`.
    """
    sets = _code_sets(codes, clients, prospects)
    first = sets.groupBy("is_client", "bits").agg(F.min("cnpj").alias("representante"))
    return sets.join(first, ["is_client", "bits"]).select("cnpj", "representante", F.col("is_client").cast("int").alias("cliente"),
                                                          F.col("n").alias("n_codigos"))


def most_similar(codes: DataFrame, clients: DataFrame, prospects: DataFrame) -> DataFrame:
    """Best customer per prospect: (cnpj, cnpj_mais_similar, similaridade).

    ``codes``: (cnpj, code), as from :func:`company_codes`; ``clients`` and
    ``prospects``: frames with a ``cnpj`` column.
    """
    sets = _code_sets(codes, clients, prospects)
    p, c = _sides(sets)
    best = (candidates(p, client_index(c, p), width_of(sets)).groupBy("rep")
            .agg(_first(_score(F.col("k"), F.col("n")), F.col("cliente")).alias("b")))
    per_set = (p.join(best, "rep")
               .select(F.col("prospect_bits").alias("bits"), F.col("b.cliente").alias("cliente"),
                       (-F.col("b.neg")).alias("similaridade")))
    scored = sets.where(~F.col("is_client")).join(per_set, "bits").select("cnpj", "cliente", "similaridade")
    return (prospects.select("cnpj").distinct().join(scored, "cnpj", "left")
            .select("cnpj", F.col("cliente").alias("cnpj_mais_similar"),
                    F.coalesce(F.col("similaridade"), F.lit(0.0)).alias("similaridade")))
