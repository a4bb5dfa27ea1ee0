"""Quality rules as a short-circuit cascade.

A document is rejected when any rule rejects it, so the order of the rules changes the work, not
the verdict. The order is chosen on a sample: each rule's cost (measured time) and selectivity
(share of rows it rejects) are estimated, and rules run by rejections per cost, best first. The
cascade is one CASE expression, which evaluates a rule only for rows that no earlier rule rejected.

Rows: a null text has no words. Extra columns are carried along; statistics replace columns of the
same name. A table without rows gives no rows. Repeated rows are judged one by one.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import bind, named

# The separators of words and the counted symbols.
OTHERS = r"[^#*$%&|<>]"
SEPARATOR_RUN = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"

# Rows of the sample on which the order of the rules is estimated; the verdicts never depend on it.
SAMPLE_ROWS = 2000


def words(text: Column) -> Column:
    """Words of a whole text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR_RUN), "")


def _count(text: Column, others: str) -> Column:
    """Code points of the text outside the character class `others`."""
    return F.char_length(F.regexp_replace(text, f"{others}+", ""))


def _covered(at: Column) -> Column:
    """Words covered by the windows of three that begin at the ascending places `at`."""
    steps = F.transform(
        at, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - i, F.lit(3)))
    )
    return F.aggregate(steps, F.lit(0), lambda a, b: a + b)


def _repeated_by_pairs(hashes: Column) -> Column:
    """Words covered by repeated windows, from (hash, place) pairs in order: for any text."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(p: Column) -> Column:
        twin = F.transform(
            p,
            lambda x, k: F.when(
                ((k > 0) & (F.get(p, k - 1)["h"] == x["h"]))
                | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)),
                x["i"],
            ),
        )
        return F.sort_array(F.filter(twin, lambda i: i.isNotNull()))

    return bind(bind(pairs, starts), _covered)


PLACE_BITS = 20


def _repeated(hashes: Column) -> Column:
    """The same from one long per window, the hash's upper bits and the place: far cheaper to sort.

    A text with too many windows, or with two hashes that differ only below the kept bits, is left
    to `_repeated_by_pairs`.
    """
    mask = (1 << PLACE_BITS) - 1
    packed = F.sort_array(
        F.transform(hashes, lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))
    )

    def of(p: Column) -> Column:
        # bits in which a window differs from the next one in order
        gap = F.transform(
            p,
            lambda x, k: F.shiftrightunsigned(
                x.bitwiseXOR(F.coalesce(F.get(p, k + 1), F.bitwise_not(x))), PLACE_BITS
            ),
        )

        def near(g: Column) -> Column:
            place = F.transform(
                p,
                lambda x, k: F.when(
                    (F.get(g, k) == 0) | F.coalesce((k > 0) & (F.get(g, k - 1) == 0), F.lit(False)),
                    x.bitwiseAND(F.lit(mask)).cast("int"),
                ),
            )
            at = F.filter(place, lambda i: i.isNotNull())

            def told(a: Column) -> Column:
                full = F.transform(a, lambda i: F.get(hashes, i))
                groups = F.size(F.array_distinct(F.transform(full, lambda h: F.shiftrightunsigned(h, PLACE_BITS))))
                return F.when(
                    groups == F.size(F.array_distinct(full)), bind(F.sort_array(a), _covered)
                ).otherwise(_repeated_by_pairs(hashes))

            return bind(at, told)

        return bind(gap, near)

    return F.when(F.size(hashes) <= mask, bind(packed, of)).otherwise(_repeated_by_pairs(hashes))


def repeat_words(w: Column) -> Column:
    """Words in 3-word windows found twice or more in the text, the first one included.

    Windows are compared by 64-bit hash; a text whose hashes are all distinct is done at once.
    """
    count = F.size(w) - 2
    windows = F.transform(
        F.slice(w, 1, F.greatest(count, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)),
    )
    return bind(
        windows,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            _repeated(h)
        ),
    )


def base_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` plus n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    t = F.coalesce(F.col(text), F.lit(""))
    (held,) = named(docs, ["counted"])
    of_words = bind(
        words(F.col(text)),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.char_length(F.array_join(w, "")).alias("chars"),
            repeat_words(w).alias("repeat"),
        ),
    )
    of_lines = bind(
        F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CHAR)),
        lambda x: F.struct(
            F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")
        ),
    )
    counted = docs.withColumn(
        held,
        F.struct(
            of_words.alias("w"),
            of_lines.alias("l"),
            _count(t, OTHERS).alias("symbols"),
        ),
    )
    return counted.withColumns(
        {
            "n_words": F.col(f"{held}.w.n").cast("long"),
            "word_chars": F.col(f"{held}.w.chars").cast("long"),
            "n_symbols": F.col(f"{held}.symbols").cast("long"),
            "n_lines": F.col(f"{held}.l.n").cast("long"),
            "n_dup_lines": F.col(f"{held}.l.dup").cast("long"),
            "n_repeat_words": F.col(f"{held}.w.repeat").cast("long"),
        }
    ).drop(held)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def default_rules(text: str = "text") -> dict[str, Column]:
    """True where a rule rejects. Whole numbers only, so that SQL gives the same verdicts."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.col("n_words")
    return {
        # more than one symbol for every ten words: encoded rubbish, tables, menus
        "symbols": 10 * F.col("n_symbols") > n,
        # words of under 2.5 or over 12 characters on average
        "word_length": (2 * F.col("word_chars") < 5 * n) | (F.col("word_chars") > 12 * n),
        # more than half of the lines stand there already
        "duplicate_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        # a third of the words repeat a phrase of the text
        "repeats": 3 * F.col("n_repeat_words") > n,
        # shouting: half of the characters of words are A-Z
        "capitals": 2 * _count(t, "[^A-Z]") > F.col("word_chars"),
        # exclamation and question marks after every other word
        "exclamation": 2 * _count(t, "[^!?]") > n,
    }


def order_rules(sample: DataFrame, rules: Mapping[str, Column]) -> list[str]:
    """Rule names by rejections per cost on `sample`, best first; ties by name.

    Each rule is timed alone over the sample, which is held in memory meanwhile. An empty sample
    gives the rules by name.
    """
    score = {}
    sample = sample.persist()
    sample.count()
    for name, rule in rules.items():
        began = time.perf_counter()
        row = sample.select(
            F.count(F.lit(1)).alias("n"), F.count(F.when(rule, 1)).alias("rejected")
        ).first()
        cost = time.perf_counter() - began
        score[name] = (row["rejected"] / row["n"] if row["n"] else 0.0) / max(cost, 1e-6)
    sample.unpersist()
    return sorted(rules, key=lambda name: (-score[name], name))


def cascade(rules: Mapping[str, Column], order: Sequence[str]) -> Column:
    """The position of the first rule in `order` that rejects, or null when all pass."""
    chain = F.when(F.lit(False), F.lit(None).cast("int"))
    for k, name in enumerate(order):
        chain = chain.when(rules[name], F.lit(k))
    return chain


def judge(
    docs: DataFrame,
    text: str = "text",
    rules: Mapping[str, Column] | None = None,
    order: Sequence[str] | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """`docs` plus the base statistics, base_failed, and kept (no rule rejects, base not failed).

    `order` fixes the cascade's order; without it, it is estimated on up to `sample_rows` rows.
    """
    counted = base_statistics(docs, text)
    rules = default_rules(text) if rules is None else rules
    if order is None:
        order = order_rules(counted.limit(sample_rows), rules)
    failed = base_failed()
    return counted.withColumns(
        {
            "base_failed": failed,
            "kept": F.when(failed, F.lit(False)).otherwise(cascade(rules, order).isNull()),
        }
    )
