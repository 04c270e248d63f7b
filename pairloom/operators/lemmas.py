"""Base forms of words that no lexicon holds, by rules learned from one.

A pair (``form``, ``lemma``) says: strip what follows the common beginning of both, and add the
rest of the lemma. Each ending of the form, from what is stripped up to ``LONGEST`` characters,
votes for that rule; an ending keeps the rule with most votes. The endings make a trie from the
right; one whose rule is that of the ending a character shorter is left out, as the longest
ending of a word decides and the shorter one says the same. Words that are their own lemma
vote too, for leaving a word as it is, and so does a word no rule fits.

All of it is counted on tables with a row per form, never on texts: rules become base forms of distinct
words, and texts are looked up in the result (``lookup.lemmatize``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.sizing import BROADCAST_BYTES, SALTS, join_table
from pairloom.session import stored

LONGEST = 6
LEAST = 2


def _common_length(a: Column, b: Column) -> Column:
    """How many characters two texts begin with in common. Where neither begins with the other, their characters
    are compared once each; a word as long as a text costs no more than reading it."""
    both = F.least(F.length(a), F.length(b))
    one, other = (F.split(F.left(x, both), "") for x in (a, b))
    first = F.array_position(F.zip_with(one, other, lambda x, y: x == y), False) - 1
    return F.when(F.startswith(a, b), F.length(b)).when(F.startswith(b, a), F.length(a)).otherwise(first).cast("int")


def _endings(form: Column, least: Column, longest: int) -> Column:
    last = F.least(F.length(form), F.lit(longest))
    return F.when(last >= least, F.transform(F.sequence(least, last), lambda k: F.right(form, k)))


def learn_rules(lexicon: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(``suffix``, ``strip``, ``added``, ``n``) from pairs (``form``, ``lemma``): words ending in ``suffix`` lose
    ``strip`` characters and gain ``added``. Rules have at least ``least`` votes; of equal votes the one that
    strips less wins, then the greater addition. Pairs with a null or an empty form are left out. Stored."""
    told = lexicon.where("form <> '' AND lemma IS NOT NULL").select("form", "lemma")
    pairs = told.withColumn("common", _common_length(F.col("form"), F.col("lemma"))).select(
        "form", (F.length("form") - F.col("common")).alias("strip"), F.expr("substring(lemma, common + 1)").alias("added")
    )
    each = pairs.select(
        F.explode_outer(_endings(F.col("form"), F.greatest(F.col("strip"), F.lit(1)), longest)).alias("suffix"), "strip", "added"
    ).where("suffix IS NOT NULL")
    votes = each.groupBy("suffix", "strip", "added").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    best = votes.groupBy("suffix").agg(F.max(F.struct("n", (-F.col("strip")).alias("kept"), "added")).alias("best"))
    rules = stored(best.select("suffix", (-F.col("best.kept")).alias("strip"), "best.added", "best.n"), "rules")
    shorter = rules.select(
        F.col("suffix").alias("rest"), F.col("strip").alias("rest_strip"), F.col("added").alias("rest_added")
    )
    met = rules.withColumn("rest", F.expr("right(suffix, length(suffix) - 1)")).join(shorter, "rest", "left")
    says_else = F.col("rest_strip").isNull() | (F.col("rest_strip") != F.col("strip")) | (F.col("rest_added") != F.col("added"))
    return stored(met.where(says_else).select("suffix", "strip", "added", "n"), "kept-rules")


def by_rules(
    forms: DataFrame, rules: DataFrame, longest: int = LONGEST, max_bytes: int = BROADCAST_BYTES, salts: int = SALTS
) -> DataFrame:
    """(``form``, ``lemma``) of each row of ``forms``, whose forms are distinct: the rule of its longest ending that
    leaves some text; a form without one, or a null, stays as it is. ``rules`` is a stored table of ``learn_rules``."""
    ends = F.coalesce(_endings(F.col("form"), F.lit(1), longest), F.array().cast("array<string>"))
    each = forms.select("form", F.explode_outer(ends).alias("suffix"))
    met = join_table(each, rules.select("suffix", "strip", "added"), "suffix", F.col("form"), "left", max_bytes, salts)
    fits = F.col("strip").isNotNull() & ((F.col("strip") < F.length("form")) | (F.col("added") != ""))
    rule = F.when(fits, F.struct(F.length("suffix").alias("length"), "strip", "added"))
    found = met.groupBy("form").agg(F.max(rule).alias("rule"))
    changed = F.concat(F.expr("left(form, length(form) - rule.strip)"), F.col("rule.added"))
    return found.select("form", F.coalesce(changed, F.col("form")).alias("lemma"))


def lemma_table(forms: DataFrame, lexicon: DataFrame, rules: DataFrame, longest: int = LONGEST, **sizes) -> DataFrame:
    """(``form``, ``lemma``) of all distinct ``forms``, by the lexicon where it holds a form and by ``rules``
    elsewhere; ready for ``lookup.lemmatize``. Stored."""
    held = lexicon.where("lemma IS NOT NULL").select("form", "lemma")
    unknown = forms.select("form").join(held, "form", "left_anti")
    known = forms.select("form").join(held, "form")
    return stored(known.union(by_rules(unknown, rules, longest, **sizes)), "lemma-table")


def held_out_accuracy(given: DataFrame, rules: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(``changed``, ``n``, ``right``): of pairs the rules weren't learned from, how many they get right, for
    words that differ from their lemma and words that don't."""
    guessed = by_rules(given.select("form"), rules, longest).withColumnRenamed("lemma", "guess")
    return given.join(guessed, "form").groupBy((F.col("form") != F.col("lemma")).alias("changed")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("guess") == F.col("lemma")).alias("right")
    )
