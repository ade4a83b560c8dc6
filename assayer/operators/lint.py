"""Board lint: what a written plan gets wrong before anything is made from it. Native map and array expressions only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.functions import text as X
from assayer.functions.verdicts import unmet_rows

# Fixed values.
RESOLVERS = ("solves", "fixes", "resolved", "explains", "reveals the product", "everything is fine")
PLACEHOLDER, NARRATOR = "{character}", "{presenter}"
HUMAN_NOUNS = (r"\b(woman|women|man|men|girls?|boys?|students?|persons?|people|someone|somebody|child|children|kids?|customers?|"
               r"friends?|workers?|guys?|lady|ladies|mothers?|fathers?|moms?|dads?)\b")
PRONOUNS = r"\b(she|her|hers|he|him|his)\b"
STOP_WORDS = ("still", "again", "behind", "front", "never", "every", "their", "there", "which", "while")
SWITCH_MODES = ("slots", "off", "cuts")
BUILDER_SLOTS = 3
SCENE_WORDS_MAX = 80

BOARD_SCHEMA = ("spot STRING, brand STRING, scenes MAP<STRING, STRING>, narration STRING, quirk STRING, hook STRING, order ARRAY<STRING>, "
                "chain ARRAY<STRING>, slots ARRAY<ARRAY<STRING>>, props ARRAY<STRING>, switches STRING, escalation BOOLEAN, "
                "character_noun STRING, scores MAP<STRING, INT>, scored_by STRING, guard STRING")


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _lower(c: str) -> Column:
    return F.lower(F.coalesce(F.col(c), F.lit("")))


def cast_ok(scene: Column) -> Column:
    """No narrator and no human noun besides the placeholder; a pronoun needs the placeholder to refer to."""
    rest = F.lower(F.replace(scene, F.lit(PLACEHOLDER), F.lit(" ")))
    unclear = rest.rlike(PRONOUNS) & ~scene.contains(PLACEHOLDER)
    return ~(unclear | rest.rlike(HUMAN_NOUNS) | scene.contains(NARRATOR))


def lint(boards: DataFrame) -> DataFrame:
    """Adds ``checks`` MAP<check, passed>, ``why`` MAP<check, reason>, ``failed`` and ``verdict``. No scenes is a FAIL."""
    c = F.col
    scenes = F.coalesce("scenes", F.create_map().cast("map<string,string>"))
    d = boards.withColumn("__s", scenes).withColumn("__keys", F.array_sort(F.map_keys("__s")))
    keys, n = c("__keys"), F.size("__keys")
    texts = F.map_values("__s")
    early = F.lower(F.array_join(F.transform(F.slice(keys, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda k: c("__s")[k]), " "))
    second = F.lower(F.coalesce(F.try_element_at("__s", F.try_element_at(keys, F.lit(2))), F.lit("")))
    resolved = F.exists(F.array(*[F.lit(r) for r in RESOLVERS]), lambda r: second.contains(r))
    shared = F.array_except(F.array_intersect(X.distinct_words(F.coalesce("quirk", F.lit(""))), X.distinct_words(F.coalesce("narration", F.lit("")))),
                            F.array(*[F.lit(w) for w in STOP_WORDS]))
    closed = F.forall(texts, lambda s: (F.lower(s).contains("mouth") & F.lower(s).contains("closed")) | F.lower(s).contains("nobody speaks"))

    has_slots = c("slots").isNotNull() & (F.size("slots") > 0)
    flat = F.flatten("slots")
    first_three = F.slice(keys, 1, BUILDER_SLOTS)
    in_chain = lambda seq: F.filter(seq, lambda k: F.array_contains("chain", k)) == c("chain")
    chain_listed = (F.size("chain") > 0) & (F.size(F.array_distinct("chain")) == F.size("chain")) & (F.size(F.array_except("chain", keys)) == 0)
    names_her = F.exists("chain", lambda k: F.coalesce(c("__s")[k].contains(PLACEHOLDER), F.lit(False)))
    chain_ok = c("chain").isNull() | (chain_listed & (has_slots | in_chain(first_three)) & ((F.coalesce("character_noun", F.lit("")) != "") | ~names_her))

    slots_ok = c("slots").isNull() | (
        has_slots & F.forall("slots", lambda s: s.isNotNull() & (F.size(s) > 0)) & (F.sort_array(flat) == keys) & (F.size("slots") == BUILDER_SLOTS)
        & (X.sentence_count(F.coalesce("narration", F.lit("")), BUILDER_SLOTS) == BUILDER_SLOTS) & (c("chain").isNull() | in_chain(flat)))
    props_ok = c("props").isNull() | (
        (F.size("props") > 0) & F.forall("props", lambda p: F.coalesce(F.trim(p) != "", F.lit(False)))
        & (F.size(F.array_distinct(F.transform("props", lambda p: F.lower(F.trim(p))))) == F.size("props")))

    # Which shot the board opens on, and which the build plays first.
    def own(k: Column) -> Column:
        return F.when(_true(F.array_contains(keys, k)), k)

    slot_first = own(F.when(has_slots, F.try_element_at(F.try_element_at("slots", F.lit(1)), F.lit(1))))
    key_first = F.try_element_at(keys, F.lit(1))
    opener = F.coalesce(own(F.try_element_at("order", F.lit(1))), own(F.try_element_at("chain", F.lit(1))), slot_first, key_first)
    played_first = F.coalesce(slot_first, key_first)
    well_formed = F.forall("slots", lambda s: s.isNotNull() & (F.size(s) > 0) & (F.size(F.array_except(s, keys)) == 0))
    played = F.when(~has_slots, first_three).when(well_formed, flat)
    order_listed = (F.size("order") > 0) & (F.size(F.array_distinct("order")) == F.size("order")) & (F.size(F.array_except("order", keys)) == 0)
    hook_why = (F.when(c("order").isNotNull() & ~_true(order_listed), "order does not list this spot's own scenes once each")
                .when(c("order").isNotNull() & played.isNotNull() & (c("order") != played), "order is not what the build plays")
                .when(F.coalesce(F.trim("hook"), F.lit("")) == "", "no hook named")
                .when(~_true(F.array_contains(keys, c("hook"))), "hook is not one of the scenes")
                .when(~c("hook").eqNullSafe(opener), F.concat(F.lit("the film opens on "), F.coalesce(opener, F.lit("nothing"))))
                .when(~played_first.eqNullSafe(opener), F.concat(F.lit("the build plays "), played_first, F.lit(" first"))))
    long = F.filter(keys, lambda k: X.word_count(c("__s")[k]) > SCENE_WORDS_MAX)
    length_why = F.when(F.size(long) > 0, F.concat(F.lit("too long: "), F.array_join(long, ", ")))

    checks = {
        "product_absent": ~early.contains(F.lower(F.coalesce("brand", "spot"))),
        "escalation": _true(c("escalation")) | ~resolved,
        "quirk_unspoken": F.size(shared) == 0,
        "mouths_closed": closed,
        "crop_clause": _lower("guard").contains("middle third"),
        "cast": F.forall(texts, cast_ok),
        "register": ~_lower("narration").rlike(PRONOUNS),
        "chain": chain_ok, "slots": slots_ok,
        "switches": c("switches").isNull() | c("switches").isin(*SWITCH_MODES),
        "props": props_ok,
        "hook_first": hook_why.isNull(), "scene_length": length_why.isNull(),
    }
    as_map = F.map_from_arrays(F.array(*[F.lit(k) for k in checks]), F.array(*[_true(v) for v in checks.values()]))
    why = F.map_filter(F.create_map(F.lit("hook_first"), hook_why, F.lit("scene_length"), length_why), lambda k, v: v.isNotNull())
    out = d.withColumn("checks", as_map).withColumn("why", why)
    out = out.withColumn("failed", F.map_keys(F.map_filter("checks", lambda k, v: ~v)))
    return out.withColumn("verdict", F.when((n > 0) & (F.size("failed") == 0), "PASS").otherwise("FAIL")).drop("__s", "__keys")


def score_card(boards: DataFrame) -> DataFrame:
    """Adds ``unmet`` judgment rows; the mechanical verdict is untouched."""
    empty = F.create_map().cast("map<string,int>")
    return boards.withColumn("unmet", unmet_rows(F.coalesce("scores", empty), F.col("scored_by")))
