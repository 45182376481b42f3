"""Resolution of store campaign texts to known campaign types.

Three rules in order: the normalised key is known; a known key starts it (the
longest one wins); a known key has the same rarest token. Every rule is an equi-join
(on the key, on the key's prefixes at token boundaries, on a token), so nothing is
compared pairwise. Ties go to the smaller key.

``fuzzy_types`` resolves misspelt texts by edit distance, also without comparing all pairs
(q-gram count filter):

* Keys may be ``allowed_edits`` apart: one edit for every PER_EDIT characters of the longer key,
  MOST_EDITS at most. An edit touches at most Q q-grams, so keys that are k edits apart and of at
  most n characters share at least n + Q - 1 - Q k of their padded q-grams (the same gram twice
  counts as two).
* So if the grams of both keys are put in one order, rarest first, the first Q k + 1 of each have
  one in common. The equi-join is on these prefix grams only; length and count bounds drop most
  of the pairs it finds, and a bounded edit distance decides the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions.text import campaign_key


Q = 2
PER_EDIT = 5
MOST_EDITS = 2


def allowed_edits(length: Column | str) -> Column:
    """Edits that two keys may be apart whose longer one has ``length`` characters."""
    length = F.col(length) if isinstance(length, str) else length
    return F.least(F.floor(length / PER_EDIT), F.lit(MOST_EDITS)).cast("int")


def _padded_grams(key: str) -> str:
    """The key's q-grams as text with their occurrence number, so that they are a set."""
    pad = "#" * (Q - 1)
    whole = f"concat('{pad}', {key}, '{pad}')"
    grams = f"transform(sequence(1, length({key}) + {Q - 1}), i -> substring({whole}, i, {Q}))"
    return f"transform({grams}, (g, i) -> concat(g, size(filter(slice({grams}, 1, i + 1), x -> x = g))))"


def _prefixes(keys: DataFrame) -> DataFrame:
    """``keys(key, ...)`` with ``prefix``: enough of its rarest grams to meet any key it may match."""
    spread = keys.select("key", F.explode(F.expr(_padded_grams("key"))).alias("gram"))
    count = spread.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    ordered = (spread.join(count, "gram").groupBy("key")
               .agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("by_rarity")))  # as many as a key has grams
    need = Q * allowed_edits(F.length("key") + MOST_EDITS) + 1
    return keys.join(ordered, "key").withColumn("prefix", F.slice(F.transform("by_rarity", lambda x: x["gram"]), F.lit(1), need)).drop("by_rarity")


def fuzzy_types(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(text, key, campaign_type, matched_key, distance) for every distinct text of ``texts(text)``: the known key with the
    fewest edits that are allowed (ties: the smaller key), nulls if there is none. ``known`` has (name, campaign_type)."""
    both = (texts.where("text is not null").select(campaign_key("text").alias("key"), F.col("text"), F.lit(None).cast("string").alias("campaign_type"))
            .unionAll(known.where("name is not null").select(campaign_key("name"), F.lit(None).cast("string"), "campaign_type")))
    return fuzzy_tagged(both)


def fuzzy_tagged(tagged: DataFrame) -> DataFrame:
    """As ``fuzzy_types``, from one frame (key, text, campaign_type) whose rows are texts (``text`` set) or known keys."""
    texts = tagged.where("text is not null").select("text", "key").distinct()
    keys = (tagged.where("key <> ''").groupBy("key")
            .agg(F.max(F.col("text").isNotNull()).alias("asked"), F.max(F.col("text").isNull()).alias("is_known"),
                 F.min("campaign_type").alias("campaign_type")))
    cut = _prefixes(keys)
    left = cut.where("asked").select("key", F.explode("prefix").alias("gram"))
    right = cut.where("is_known").select(F.col("key").alias("matched_key"), "campaign_type", F.explode("prefix").alias("gram"))
    longer = F.greatest(F.length("key"), F.length("matched_key"))
    pairs = (left.join(right, "gram").where(F.abs(F.length("key") - F.length("matched_key")) <= allowed_edits(longer))
             .select("key", "matched_key", "campaign_type").distinct())
    far = F.levenshtein("key", "matched_key", MOST_EDITS)
    near = (pairs.withColumn("distance", far).where((F.col("distance") >= 0) & (F.col("distance") <= allowed_edits(longer)))
            .groupBy("key").agg(F.min(F.struct("distance", "matched_key", "campaign_type")).alias("best")))
    # short keys allow no edit and meet by equality
    same = keys.where("asked and is_known").select("key", F.struct(F.lit(0).alias("distance"), F.col("key").alias("matched_key"), "campaign_type").alias("same"))
    out = texts.join(same, "key", "left").join(near, "key", "left").withColumn("hit", F.coalesce("same", "best"))
    return out.select("text", "key", "hit.campaign_type", "hit.matched_key", "hit.distance")


def resolve_types(texts: DataFrame, known: DataFrame) -> DataFrame:
    """(text, key, campaign_type, matched_key, method) for every distinct text of ``texts(text)``.
    ``known`` has (name, campaign_type). method: exact, prefix, token or none."""
    ref = (known.select(campaign_key("name").alias("matched_key"), "campaign_type").where("matched_key <> ''")
           .groupBy("matched_key").agg(F.min("campaign_type").alias("campaign_type")))
    keys = texts.where("text is not null").select("text", campaign_key("text").alias("key")).distinct()
    parts = F.split("key", "_")
    # the prefixes at token boundaries: the whole key is the exact match
    starts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "_"))
    lead = (keys.select("text", F.explode(starts).alias("matched_key")).join(ref, "matched_key")
            .groupBy("text").agg(F.max_by(F.struct("matched_key", "campaign_type"), F.length("matched_key")).alias("lead")))
    # rarest token of each known key, by the number of known keys that have it
    tokens = ref.select("matched_key", "campaign_type", F.explode(F.array_distinct(F.split("matched_key", "_"))).alias("token"))
    count = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rare = (tokens.join(count, "token").groupBy("matched_key", "campaign_type")
            .agg(F.min_by("token", F.struct("n", "token")).alias("token"), F.min("n").alias("n")))
    by_token = (keys.select("text", F.explode(F.array_distinct(parts)).alias("token")).join(rare, "token")
                .groupBy("text").agg(F.min_by(F.struct("matched_key", "campaign_type"), F.struct("n", "matched_key")).alias("near")))
    out = keys.join(lead, "text", "left").join(by_token, "text", "left")
    hit = F.coalesce("lead", "near")
    method = (F.when(F.col("lead.matched_key") == F.col("key"), "exact").when(F.col("lead").isNotNull(), "prefix")
              .when(F.col("near").isNotNull(), "token").otherwise("none"))
    return out.select("text", "key", hit["campaign_type"].alias("campaign_type"), hit["matched_key"].alias("matched_key"),
                      method.alias("method"))
