"""Item-set operators: ordered dedupe, tail drop, keyword filters, numbering."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsift.functions.params import normalise_term_list
from mailsift.functions.text import ustrip
from mailsift.operators.order import (
    OrderSpec, first_per_key, last_k_per_group, order_columns, ordinal, sort_exprs,
)
from mailsift.session import written

# Newest message first, then document order: the run's item order.
ITEM_ORDER: OrderSpec = [("uid", False), ("pos", True)]


def dedupe_first(df: DataFrame, keys: Sequence[str] = ("title", "link"),
                 order: OrderSpec = ITEM_ORDER, by: Sequence[str] = ()) -> DataFrame:
    """First ``keys`` occurrence in ``order`` wins and keeps its own columns.

    ``by`` scopes the dedupe (e.g. per report). Not ``dropDuplicates``,
    which keeps an arbitrary row.
    """
    return first_per_key(df, [*by, *keys], order)


def drop_tail(df: DataFrame, order: OrderSpec = ITEM_ORDER, k: int = 2,
              by: Sequence[str] = ()) -> DataFrame:
    """If a group has at least ``k`` rows, drop its last ``k``; else keep all.

    No global sort: the last ``k`` rows are found by a reverse top-k
    (``TakeOrderedAndProject`` without ``by``, map-side limited
    ``WindowGroupLimit`` with ``by``), the ``>= k`` guard is a count over
    those at most ``k`` rows per group, and the drop is a left-anti join on
    the order key. Null group and order keys compare as equal, so a null group
    is a group like any other. ``order`` must name a row within its group: with
    several mailboxes it holds the mailbox columns too.

    ``df`` is read twice (to find the tail and to remove it); when it is
    expensive to compute, write it first (``session.written``).
    """
    if k <= 0:
        return df
    by = list(by)
    key = [*by, *[c for c in order_columns(order) if c not in by]]
    if by:
        tail = last_k_per_group(df.select(*key), by, order, k)
        w = Window.partitionBy(*by)
    else:
        tail = df.select(*key).orderBy(*sort_exprs(order, reverse=True)).limit(k)
        w = Window.partitionBy()
    gone = (tail.withColumn("__tn", F.count(F.lit(1)).over(w)).filter(F.col("__tn") >= k)
            .select(*[F.col(c).alias(f"__gone_{c}") for c in key]))
    same = F.lit(True)
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"__gone_{c}"))
    return df.join(gone, same, "left_anti")


def keyword_blob(title_col: str = "title", abstract_col: str = "abstract"):
    """``lower(title + ' ' + abstract)``; a null abstract counts as ``''``."""
    return F.lower(F.concat_ws(" ", F.coalesce(F.col(title_col), F.lit("")),
                               F.coalesce(F.col(abstract_col), F.lit(""))))


def keyword_filter(df: DataFrame, terms: Sequence[str] | str | None,
                   title_col: str = "title", abstract_col: str = "abstract") -> DataFrame:
    """Keep items whose lower-cased title+abstract contains any term (substring).

    Terms are normalised like the source's config (S3). An empty list passes
    everything. The predicate is an OR of ``contains`` - narrow, codegen'd.
    """
    terms = normalise_term_list(terms)
    if not terms:
        return df
    blob = keyword_blob(title_col, abstract_col)
    cond = F.lit(False)
    for t in terms:
        cond = cond | blob.contains(F.lit(t))
    return df.filter(cond)


GRAM = 6          # characters of a gram (a shorter term is its own)
SET_WORDS = 4096  # 64-bit words of a gram set: 32 KB, whatever the number of grams


def _grams(text: Column, widths: Sequence[int]) -> Column:
    """All character grams of the widths; a lookahead takes overlapping ones in one linear pass."""
    found = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{w}}}))"), 1) for w in widths]
    return found[0] if len(found) == 1 else F.flatten(F.array(*found))


def _gram_set(grams: DataFrame) -> tuple[list[int], Callable[[Column], Column]]:
    """The widths of ``grams``, and a test that each of them passes (and few others).

    The test is one bit for each hash. At most ``SET_WORDS`` rows come to the driver;
    beyond some hundred thousand grams it lets more through and the join that
    follows does its work.
    """
    rows = (grams.select(F.expr(f"shiftrightunsigned(xxhash64(gram), 6) & {SET_WORDS - 1}").alias("word"),
                         F.expr("shiftleft(1L, cast(xxhash64(gram) & 63 as int))").alias("bit"),
                         F.length("gram").alias("width"))
            .groupBy("word").agg(F.bit_or("bit").alias("bits"), F.collect_set("width").alias("widths"))
            .collect())
    bits = {r["word"]: r["bits"] for r in rows}
    words = F.split(F.lit(",".join(str(bits.get(i, 0)) for i in range(SET_WORDS))), ",") \
        .cast("array<bigint>")

    def test(gram: Column) -> Column:
        h = F.xxhash64(gram)
        word = words[F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(SET_WORDS - 1)).cast("int")]
        return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1

    return sorted({w for r in rows for w in r["widths"]}), test


def term_anchors(texts: DataFrame, terms: DataFrame, text: Column) -> DataFrame | None:
    """``term, gram, n``: for each term the gram of it that is rarest in the texts, and how rare.

    The frequencies of all grams of all terms are counted over all texts, added up
    before the shuffle. A term with a gram that no text has matches nothing and
    goes. None if there are no terms.
    """
    steps = F.sequence(F.lit(1), F.greatest(F.length("term") - GRAM + 1, F.lit(1)))
    parts = written(terms.select("term", F.explode(F.array_distinct(F.transform(
        steps, lambda i: F.substring(F.col("term"), i, F.lit(GRAM))))).alias("gram")), "term-grams")
    widths, test = _gram_set(parts)
    if not widths:
        return None
    counts = (texts.select(F.explode(_grams(text, widths)).alias("gram")).filter(test(F.col("gram")))
              .groupBy("gram").agg(F.count(F.lit(1)).alias("n")))
    return written(parts.join(counts, "gram", "left").groupBy("term")
                   .agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"),
                        F.min(F.coalesce("n", F.lit(0))).alias("n"))
                   .filter("n > 0"), "anchors")


def keyword_candidates(df: DataFrame, terms_df: DataFrame, row_key: Sequence[str],
                       term_col: str = "term", title_col: str = "title",
                       abstract_col: str = "abstract") -> DataFrame | None:
    """``__of_<key>..., term``: the pairs of a row and a term whose anchor the row holds.

    A text that contains a term contains the term's rarest gram, its anchor. Grams
    that are no anchor leave with the scan (a bit test, no join); the others are
    equi-joined to the anchors. None if there are no terms.
    """
    terms = terms_df.select(F.lower(ustrip(F.col(term_col))).alias("term")) \
        .filter(F.col("term") != "").distinct()
    blob = keyword_blob(title_col, abstract_col)
    anchors = term_anchors(df, terms, blob)
    if anchors is None:
        return None
    widths, test = _gram_set(anchors)
    return (df.select(*[F.col(k).alias(f"__of_{k}") for k in row_key],
                      F.explode(_grams(blob, widths or [GRAM])).alias("gram"))
            .filter(test(F.col("gram"))).join(anchors.drop("n"), "gram").drop("gram"))


def keyword_semi_join(df: DataFrame, terms_df: DataFrame, row_key: Sequence[str],
                      term_col: str = "term", title_col: str = "title",
                      abstract_col: str = "abstract") -> DataFrame:
    """I4: keyword any-match with the terms as a table; one plan at every size.

    Terms are normalised like a term list (S3). Each row's candidate terms
    (``keyword_candidates``) come back to it by ``row_key``, which names a row, and
    are verified with ``contains``. Nothing is collected. No terms: ``df`` as is.
    """
    found = keyword_candidates(df, terms_df, row_key, term_col, title_col, abstract_col)
    if found is None:
        return df
    found = found.groupBy(*[f"__of_{k}" for k in row_key]).agg(F.collect_set("term").alias("__terms"))
    same = F.lit(True)
    for k in row_key:
        same = same & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return (df.join(found, same)
            .filter(F.exists("__terms", lambda t: F.contains(keyword_blob(title_col, abstract_col), t)))
            .select(*df.columns))


def number_items(df: DataFrame, order: OrderSpec = ITEM_ORDER, by: Sequence[str] = (),
                 name: str = "ordinal", skew_safe: bool = True) -> DataFrame:
    """1-based ordinal per ``by`` group (per report) in ``order``.

    Skew-safe by default: a report holding a third of all items is numbered
    by range slices plus offsets, never by one task.
    """
    return ordinal(df, list(by), order, name=name, skew_safe=skew_safe)


def non_empty_groups(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """The report keys that have at least one row (empty reports do not exist)."""
    return df.select(*by).distinct()
