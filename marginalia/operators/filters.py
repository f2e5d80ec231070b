"""Which records are kept: five dimensions, all of which must hold; an empty dimension is inactive."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.text import strip_site


@dataclass
class WorkFilter:
    """Membership is exact and case-sensitive; a null value is in no set."""

    domains: list[str] = field(default_factory=list)
    topics: list[str] = field(default_factory=list)
    languages: list[str] = field(default_factory=list)
    work_types: list[str] = field(default_factory=list)
    require_abstract: bool = False

    def merged(self, other: WorkFilter) -> WorkFilter:
        """This filter where `other`, given on the command line, is silent; abstracts are required if either asks for them."""
        lists = {n: getattr(other, n) or getattr(self, n) for n in ("domains", "topics", "languages", "work_types")}
        return WorkFilter(**lists, require_abstract=self.require_abstract or other.require_abstract)

    def condition(self, w: Column) -> Column:
        """The filter as a condition on a parsed record; never null."""
        kept = F.lit(True)
        if self.languages:
            kept = kept & w["language"].isin(self.languages)
        if self.work_types:
            kept = kept & w["type"].isin(self.work_types)
        if self.require_abstract:
            kept = kept & (F.size(w["abstract_inverted_index"]) > 0)
        if self.domains or self.topics:

            def hit(t: Column) -> Column:
                one = F.lit(False)
                if self.domains:
                    one = one | F.coalesce(t["domain"]["display_name"].isin(self.domains), F.lit(False))
                if self.topics:
                    one = one | F.coalesce(strip_site(t["id"]).isin(self.topics), F.lit(False))
                return one

            kept = kept & (hit(w["primary_topic"]) | F.coalesce(F.exists(w["topics"], hit), F.lit(False)))
        return F.coalesce(kept, F.lit(False))


def since(shards: DataFrame, date: str) -> DataFrame:
    """Shards dated on or after `date`, compared as text; undated ones are dropped."""
    return shards.where(F.col("updated_date") >= date)


def pending(shards: DataFrame, completed: DataFrame, force: bool = False, most: int | None = None) -> DataFrame:
    """Shards without those of `completed` (shard_idx), unless forced; at most `most` of them, in order of the listing."""
    left = shards if force else shards.join(completed.select("shard_idx"), "shard_idx", "left_anti")
    return left if most is None else left.orderBy("shard_idx", *(["url"] if "url" in left.columns else [])).limit(most)


def embeddable(works: DataFrame, text: str = "text") -> DataFrame:
    return works.where(F.col(text) != "")
