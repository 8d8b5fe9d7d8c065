"""Mixing sources to target weights by budgets on a tree: domain, language, source.

A total of tokens is dealt down the tree. The children of a node share its budget by
weight, none above what its leaves hold times EPOCHS; what a child cannot take goes to its
siblings by weight. As a child's bound covers its whole subtree, a shortage is made up
inside the smallest subtree that can, and reaches the siblings of an ancestor only if
the whole subtree below is used up. Budgets are whole tokens, rounded down.

A leaf's documents form seeded epochs: epoch e holds all of them, ordered by
md5(seed:e:doc_id). The leaf takes whole epochs while its budget lasts, then the documents
of the next epoch from the start on, as long as their tokens fit. The last key that fits
is found without ordering a leaf in one task: sums of 4,096 cells of keys give the cell
that holds it, sums of its 4,096 cells the next, and only that cell's keys, a 16-millionth of
the leaf, are ordered.

Null domain, language or source counts as the empty name, null text as no tokens. Rows
with one id share a key and stay or go together. A leaf without tokens gives nothing. An
empty table gives an empty table. Only DataFrame operations are used.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from parcelsight.llm.common import stored, text_of, whole_row

LEVELS = ["domain", "language", "source"]
EPOCHS = 4
_DIGITS = 3


@dataclass(frozen=True)
class Targets:
    """Weights by level and name (1 for others), and the total in hundredths of all tokens."""

    domain: dict[str, int] = field(default_factory=lambda: {"web": 4, "books": 3, "code": 2, "forum": 1})
    language: dict[str, int] = field(default_factory=lambda: {"en": 4, "de": 2, "fr": 2, "es": 1})
    source: dict[str, int] = field(default_factory=lambda: {"src0": 3})
    hundredths: int = 60
    epochs: int = EPOCHS
    seed: int = 17

    def weight(self, level: str) -> Column:
        named = getattr(self, level)
        if not named:
            return F.lit(1)
        table = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
        return F.coalesce(F.element_at(table, F.col(level)), F.lit(1))


def tokens_of(text: Column) -> Column:
    """Words between blanks."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def domain_of(source: Column) -> Column:
    """The domain of a source: by the number that ends its name."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1)
    names = F.array(*[F.lit(x) for x in ("web", "books", "code", "forum")])
    return F.when(number == "", F.lit("other")).otherwise(F.element_at(names, (number.cast("int") % 4 + 1).cast("int")))


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, the leaf's names and the tokens of each row."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    language = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    return docs.select(
        "doc_id", domain_of(source).alias("domain"), language.alias("language"), source.alias("source"), tokens_of(text_of()).alias("n_tokens")
    )


def _exact(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def _dealt(children: DataFrame, parents: list[str], level: str, targets: Targets) -> DataFrame:
    """The budget of each child. children: its names, `room` and the parent's `budget`."""
    family, ratio = Window.partitionBy(*parents), F.col("room") / F.col("weight")
    earlier = family.orderBy(ratio, level).rowsBetween(Window.unboundedPreceding, -1)
    later = family.orderBy(ratio, level).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("room").over(earlier), F.lit(0))
    full = _exact(left) * F.col("weight") >= _exact(F.col("room")) * F.sum("weight").over(later)
    marked = children.withColumn("weight", targets.weight(level)).withColumn("full", full)
    used = F.coalesce(F.sum(F.when(F.col("full"), F.col("room"))).over(family), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(family)
    part = marked.withColumn("used", used).withColumn("open_weight", open_weight)
    share = F.expr("cast((cast(budget - used as decimal(27,0)) * cast(weight as decimal(10,0))) div open_weight as bigint)")
    return part.withColumn("given", F.when(F.col("full"), F.col("room")).otherwise(share)).drop(
        "weight", "full", "used", "open_weight", "budget"
    )


def budgets(leaves: DataFrame, targets: Targets) -> DataFrame:
    """domain, language, source, tokens and budget of each leaf (domain, language, source, tokens)."""
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first()["n"]
    nodes = leaves.withColumn("room", F.col("tokens") * targets.epochs)
    given = None
    for depth, level in enumerate(LEVELS):
        own, above = LEVELS[: depth + 1], LEVELS[:depth]
        children = nodes.groupBy(*own).agg(F.sum("room").alias("room"))
        if given is None:
            most = total * targets.hundredths // 100
            children = children.withColumn("budget", F.lit(most).cast("long"))
        else:
            children = children.join(given.select(*above, F.col("given").alias("budget")), above)
        given = _dealt(children, above, level, targets)
    return leaves.join(given.select(*LEVELS, F.col("given").alias("budget")), LEVELS)


def _key(targets: Targets) -> Column:
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(targets.seed)), F.col("whole").cast("string"), doc_id))


def cuts(rows: DataFrame, targets: Targets) -> DataFrame:
    """Per leaf: whole epochs, and the last key of the next one that fits (null: none)."""
    leaves = stored(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    dealt = budgets(leaves, targets)
    whole = F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)).cast("long")
    dealt = dealt.withColumn("whole", whole).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    dealt = stored(dealt, "mix-budgets")
    keyed = rows.join(dealt.select(*LEVELS, "whole", "rest"), LEVELS).withColumn("key", _key(targets))
    keyed = keyed.select(*LEVELS, "key", "n_tokens", "rest")
    in_order = Window.partitionBy(*LEVELS).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for digits in (_DIGITS, 2 * _DIGITS):
        cells = keyed.groupBy(*LEVELS, F.substring("key", 1, digits).alias("cell")).agg(
            F.sum("n_tokens").alias("n"), F.first("rest").alias("rest")
        )
        summed = cells.withColumn("up_to", F.sum("n").over(in_order)).where("up_to > rest")
        edge = summed.groupBy(*LEVELS).agg(F.min(F.struct("cell", (F.col("rest") - F.col("up_to") + F.col("n")).alias("left"))).alias("edge"))
        edge = stored(edge.select(*LEVELS, "edge.cell", "edge.left"), "mix-cells")
        keyed = keyed.join(edge, LEVELS).where(F.substring("key", 1, digits) == F.col("cell"))
        keyed = keyed.select(*LEVELS, "key", "n_tokens", F.col("left").alias("rest"))
    by_key = keyed.groupBy(*LEVELS, F.col("key").alias("cell")).agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"))
    fits = by_key.withColumn("up_to", F.sum("n").over(in_order)).where("up_to <= rest")
    last = fits.groupBy(*LEVELS).agg(F.max("cell").alias("last_key"))
    found = dealt.join(edge.select(*LEVELS, "cell"), LEVELS, "left").join(last, LEVELS, "left")
    return stored(found.select(*LEVELS, "whole", F.coalesce("last_key", "cell").alias("last_key")), "mix-cuts")


def _copies(targets: Targets) -> Column:
    more = F.coalesce(_key(targets) <= F.col("last_key"), F.lit(False))
    return F.col("whole") + more.cast("long")


def chosen(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """One row per row of docs: doc_id, domain, language, source, n_tokens, copies (how often it
    is taken)."""
    rows = stored(placed(docs), "mix-rows")
    return rows.join(cuts(rows, targets), LEVELS).select("doc_id", *LEVELS, "n_tokens", _copies(targets).alias("copies"))


def mixed(docs: DataFrame, targets: Targets = Targets()) -> DataFrame:
    """The rows of docs with all columns, each as often as it is taken."""
    rows = stored(placed(docs), "mix-rows")
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    language = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    named = [domain_of(source).alias("domain"), language.alias("language"), source.alias("source")]
    joined = docs.select(whole_row(docs), "doc_id", *named).join(cuts(rows, targets), LEVELS)
    taken = joined.select("_row", _copies(targets).cast("int").alias("copies")).where("copies > 0")
    return taken.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("_row.*")


def sql(targets: Targets = Targets()) -> str:
    """`chosen` in DuckDB SQL, on the table documents."""
    weights = {
        level: f"case {level} " + " ".join(f"when '{k}' then {w}" for k, w in getattr(targets, level).items()) + " else 1 end"
        for level in LEVELS
    }
    number = "regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1)"
    steps = [
        f"""rows as (select doc_id, coalesce(lang, '') as language, coalesce(source, '') as source,
  case when {number} = '' then 'other' else ['web','books','code','forum'][cast({number} as int) % 4 + 1] end as domain,
  cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as n_tokens from documents)""",
        "leaves as (select domain, language, source, cast(sum(n_tokens) as bigint) as tokens from rows group by all)",
        f"given0 as (select cast(sum(tokens) as hugeint) * {targets.hundredths} // 100 as given from leaves)",
    ]
    for depth, level in enumerate(LEVELS, 1):
        own, above = ", ".join(LEVELS[:depth]), ", ".join(LEVELS[: depth - 1])
        family = f"partition by {above} " if above else ""
        join = f"join given{depth - 1} using ({above})" if above else "cross join given0"
        steps.append(
            f"""nodes{depth} as (select {own}, cast(sum(tokens) as hugeint) * {targets.epochs} as room, {weights[level]} as weight
  from leaves group by {own}),
marked{depth} as (select *, (given - coalesce(sum(room) over (w rows between unbounded preceding and 1 preceding), 0)) * weight
    >= room * sum(weight) over (w rows between current row and unbounded following) as is_full
  from nodes{depth} {join} window w as ({family}order by room / weight, {level})),
given{depth} as (select {own}, case when is_full then room else
    (given - coalesce(sum(room) filter (where is_full) over f, 0)) * weight // (sum(weight) filter (where not is_full) over f) end as given
  from marked{depth} window f as ({family.strip()}))"""
        )
    steps += [
        """dealt as (select *, case when tokens > 0 then given // tokens else 0 end as whole from leaves join given3 using (domain, language, source))""",
        f"""keyed as (select *, given - whole * tokens as rest,
    md5('{targets.seed}:' || whole || ':' || coalesce(cast(doc_id as varchar), '')) as key
  from rows join dealt using (domain, language, source))""",
        """summed as (select *, sum(n_tokens) over (partition by domain, language, source order by key) as up_to from keyed)""",
    ]
    return (
        "with " + ",\n".join(steps) + "\nselect doc_id, domain, language, source, n_tokens,\n"
        "  cast(whole as bigint) + case when tokens > 0 and up_to <= rest then 1 else 0 end as copies from summed"
    )
