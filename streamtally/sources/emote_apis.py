"""Emote catalogs of four services, each with its own document shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtally.functions.ratio import rows

_NAMED = "array<struct<id: string, name: string>>"
_CODED = "array<struct<id: string, code: string>>"
_SETS = f"default_sets array<string>, sets map<string, struct<emoticons: {_NAMED}>>"


def _none() -> Column:
    return F.array().cast(_NAMED)


def _list(entries: Column) -> Column:
    return F.coalesce(entries, _none())


def _by_code(entries: Column) -> Column:
    return F.transform(
        F.coalesce(entries, F.array().cast(_CODED)),
        lambda e: F.struct(e["id"].alias("id"), e["code"].alias("name")),
    )


def flatten_emote_sets(sets: Column, chosen: Column) -> Column:
    """Emotes of the `chosen` set ids, in that order; a set that is not there adds nothing."""
    per_set = F.transform(F.coalesce(chosen, F.array().cast("array<string>")), lambda i: sets[i]["emoticons"])
    return F.flatten(F.filter(per_set, lambda found: found.isNotNull()))


def emote_list(body: str) -> Column:
    """The emotes of one document as array<struct<id, name>>, empty if the document is broken.

    Which shape applies follows from columns `service` and `scope`. Ids become strings.
    """
    service, everywhere = F.col("service"), F.col("scope") == "global"
    twitch = F.from_json(body, f"data {_NAMED}")["data"]
    seven_all = F.from_json(body, f"emotes {_NAMED}")["emotes"]
    seven_own = F.from_json(body, f"emote_set struct<emotes: {_NAMED}>")["emote_set"]["emotes"]
    bttv_all = F.from_json(body, _CODED)
    bttv_own = F.from_json(body, f"channelEmotes {_CODED}, sharedEmotes {_CODED}")
    ffz = F.from_json(body, _SETS)
    return (
        F.when(service == "twitch", _list(twitch))
        .when((service == "7tv") & everywhere, _list(seven_all))
        .when(service == "7tv", _list(seven_own))
        .when((service == "bttv") & everywhere, _by_code(bttv_all))
        .when(service == "bttv", F.concat(_by_code(bttv_own["channelEmotes"]), _by_code(bttv_own["sharedEmotes"])))
        .when((service == "ffz") & everywhere, flatten_emote_sets(ffz["sets"], ffz["default_sets"]))
        .when(service == "ffz", flatten_emote_sets(ffz["sets"], F.map_keys(ffz["sets"])))
        .otherwise(_none())
    )


def parse_emote_catalogs(responses: DataFrame, body: str = "body") -> DataFrame:
    """`responses` (service, scope, channel, fetched_at, body) to catalog rows. One broken
    document loses only its own emotes."""
    return (
        responses.select("service", "scope", "channel", "fetched_at", F.explode(emote_list(body)).alias("_e"))
        .select(
            "service", "scope", "channel",
            F.col("_e.id").alias("emote_id"),
            F.col("_e.name").alias("emote_code"),
            "fetched_at",
        )
    )


def emote_catalog_counts(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("service").agg(rows().alias("emote_count"))
