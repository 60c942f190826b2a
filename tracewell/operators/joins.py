"""Joins that Spark would plan as nested loops, as equi joins; and lookups with a rule for ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions.names import last_part, route_key, segment_similarity


def suffix_join(left: DataFrame, right: DataFrame, left_name: str, right_name: str, case_sensitive: bool = False, both_ways: bool = True, when: Column | None = None) -> DataFrame:
    """left outer join on: names equal, or the left one is the right one's last part, or (both_ways) the reverse.

    Two names that match in any of these ways have the same last part, so that is the join key, and the alternatives
    are checked on what it brings together. `when` is a condition on the left side; rows that fail it match nothing.
    """
    fold = (lambda c: c) if case_sensitive else F.upper
    a, b = fold(left[left_name]), fold(right[right_name])
    alike = (a == b) | (a == last_part(b))
    if both_ways:
        alike = alike | (last_part(a) == b)
    on = (last_part(a) == last_part(b)) & alike
    return left.join(right, on if when is None else on & when, "left")


def wildcard_column_join(left: DataFrame, right: DataFrame, left_table: str, left_column: str, right_table: str, right_column: str) -> DataFrame:
    """left outer join on table and column, where a null or blank column on the left stands for all of the table's."""
    norm = lambda c: F.upper(F.trim(c))
    any_column = left[left_column].isNull() | (F.trim(left[left_column]) == "")
    return left.join(right, (norm(left[left_table]) == norm(right[right_table])) & (any_column | (norm(left[left_column]) == norm(right[right_column]))), "left")


def last_wins(lookup: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row for each key: the value of its last row in this order."""
    return lookup.groupBy(key).agg(F.max_by(value, order).alias(value))


def remaining(work: DataFrame, done: DataFrame, name: str) -> DataFrame:
    """What has not been done yet, names compared in any case."""
    finished = done.select(F.upper(name).alias("_done")).where("_done is not null").distinct()
    return work.join(finished, F.upper(work[name]) == F.col("_done"), "left_anti")


def word_references(files: DataFrame, names: DataFrame, content: str, name: str) -> DataFrame:
    """Files and the names that occur in them as whole words, in any case: the columns of both, less the content.

    Names of word characters are looked up among a file's distinct words, which travel without the file's text. Only for
    names with other characters, which no word equals, is the text fetched, of the files that have the name's longest word.
    """
    keys = [c for c in files.columns if c != content]
    numbered = files.withColumn("_file", F.xxhash64(*files.columns))
    words = numbered.select(*keys, "_file", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(content), F.lit(r"(\w+)"), 1))).alias("_word"))
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\w+)"), 1)
    known = names.where(F.col(name).isNotNull()).withColumn("_parts", parts).where(F.size("_parts") > 0)
    longest = F.array_max(F.transform("_parts", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    known = known.withColumn("_key", longest).drop("_parts")
    plain, other = known.where(F.col("_key") == F.lower(name)), known.where(F.col("_key") != F.lower(name))
    found = words.join(plain, words["_word"] == plain["_key"]).select(*keys, *names.columns)
    likely = words.select("_file", "_word").join(other, F.col("_word") == other["_key"]).select("_file", *names.columns).distinct()
    quoted = F.concat(F.lit(r"\b\Q"), F.lower(name), F.lit(r"\E\b"))
    checked = numbered.join(likely, "_file").where(F.regexp_like(F.lower(content), quoted)).select(*keys, *names.columns)
    return found.unionByName(checked)


def _grams(text: str, size: int) -> Column:
    """What has this many characters from each place of a text."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1))), lambda i: F.substr(F.col(text), i, F.lit(size)))


def likely_names(texts: DataFrame, names: DataFrame, text: str, name: str, id_: str = "_text") -> DataFrame:
    """id_ of texts and the names that may be in them: each name is joined on the one of its three-character grams that the fewest texts have.

    Shorter names are their own gram. Of grams in equally many texts, that of the fewest names counts; a name with a gram
    that no text has is in none. Names that begin or end alike are so told apart by what is rare in them.
    """
    known = names.where(F.length(name) > 0).select(F.col(name).alias("_name")).distinct()
    size = F.least(F.length("_name"), F.lit(3))
    cut = known.select("_name", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("_name") - size + 1), lambda i: F.substr("_name", i, size)))).alias("_gram"))
    spread = cut.groupBy("_gram").agg(F.count("*").alias("_names"))
    all_grams = F.array_distinct(F.concat(*(_grams(text, n) for n in (3, 2, 1))))
    held = texts.select(id_, F.explode(all_grams).alias("_gram")).join(spread, "_gram", "left_semi")
    frequency = spread.join(held.groupBy("_gram").agg(F.count("*").alias("_texts")), "_gram", "left")
    weight = F.struct(F.coalesce("_texts", F.lit(0)).alias("texts"), F.col("_names").alias("names"), F.col("_gram").alias("gram"))
    rarest = cut.join(frequency, "_gram").groupBy("_name").agg(F.min(weight).alias("_least")).where("_least.texts > 0")
    return held.join(rarest.select("_name", F.col("_least.gram").alias("_gram")), "_gram").select(id_, "_name").distinct()  # rows that repeat have one id


def contained_names(texts: DataFrame, names: DataFrame, text: str, name: str) -> DataFrame:
    """Texts and the known names that are substrings of them: the columns of both. Empty names are in none."""
    numbered = texts.withColumn("_text", F.xxhash64(*texts.columns))
    found = numbered.join(likely_names(numbered, names, text, name), "_text").where(F.col(text).contains(F.col("_name")))
    wanted = [*(f"t.`{c}`" for c in texts.columns), *(f"n.`{c}`" for c in names.columns)]
    return found.alias("t").join(names.alias("n"), F.col("t._name") == F.col(f"n.`{name}`")).select(*wanted)


def enclosing_range(points: DataFrame, ranges: DataFrame, key: str, at: str, low: str, high: str, order: str, width: int = 64) -> DataFrame:
    """Each point with the first range, in this order, of its key that holds it; points in no range keep null.

    Ranges are listed under each tile of `width` that they touch, so the join is on key and tile.
    """
    tiled = ranges.withColumn("_tile", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    keyed = points.withColumn("_point", F.monotonically_increasing_id())
    wanted = [c for c in ranges.columns if c != key]
    hit = keyed.alias("p").join(tiled.alias("r"), (F.col(f"p.{key}") == F.col(f"r.{key}")) & (F.floor(F.col(f"p.{at}") / width) == F.col("r._tile")) & F.col(f"p.{at}").between(F.col(f"r.{low}"), F.col(f"r.{high}")), "left")
    best = hit.groupBy(*(F.col(f"p.{c}") for c in keyed.columns)).agg(F.min_by(F.struct(*(F.col(f"r.{c}") for c in wanted)), F.col(f"r.{order}")).alias("_range"))
    return best.select(*points.columns, "_range.*")


def rare_first(sets: DataFrame, id_: str, item: str, frequency: DataFrame, share: float) -> DataFrame:
    """id, size, with (the size of another set) and item: of each set, for each size that a set of Jaccard similarity `share` can have, its rarest items, so many that two such sets have one of them in common."""
    ordered = sets.join(frequency, item).groupBy(id_).agg(F.sort_array(F.collect_list(F.struct("_n", item))).alias("_items"))  # a path's segments
    size = F.size("_items")
    sizes = ordered.select(id_, "_items", size.alias("size"), F.explode(F.sequence(F.ceil(share * size - 1e-9).cast("int"), F.floor(size / share + 1e-9).cast("int"))).alias("with"))
    common = F.ceil(share / (1 + share) * (F.col("size") + F.col("with")) - 1e-9)
    kept = F.slice("_items", F.lit(1), F.greatest(F.col("size") - common + 1, F.lit(0)).cast("int"))
    return sizes.select(id_, "size", "with", F.explode(kept).alias("_i")).select(id_, "size", "with", F.col(f"_i.{item}").alias(item))


def similar_segments(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """_call and _rank of paths (_call or _rank, _path, _method) of one method that may have a similarity of threshold or more.

    Segments are ordered by how often they come, rarest first, and for each size of the other path only as many of the
    first ones are joined on as two similar paths of these sizes must share one of: what nearly all paths share is hardly
    ever a key.
    """
    cut = lambda df, id_: df.select(F.struct(F.col(id_).alias("id"), F.col("_method").alias("method")).alias("_id"), F.explode(F.array_distinct(F.split("_path", "/"))).alias("_segment"))
    calls, routes = cut(left, "_call"), cut(right, "_rank")
    frequency = calls.select("_segment").unionByName(routes.select("_segment")).groupBy("_segment").agg(F.count("*").alias("_n"))
    calls, routes = (rare_first(x, "_id", "_segment", frequency, threshold) for x in (calls, routes))
    calls = calls.select(F.col("_id.id").alias("_call"), F.col("_id.method").alias("_m"), F.col("size").alias("_l"), F.col("with").alias("_r"), "_segment")
    routes = routes.select(F.col("_id.id").alias("_rank"), F.col("_id.method").alias("_m"), F.col("with").alias("_l"), F.col("size").alias("_r"), "_segment")
    return calls.join(routes, ["_m", "_l", "_r", "_segment"]).select("_call", "_rank").distinct()


def match_routes(calls: DataFrame, routes: DataFrame, call_path: str, route_path: str, method: str, order: str, threshold: float = 0.6, base: str = "") -> DataFrame:
    """Each call with its route: the first whose segments agree, else the most similar over the threshold, else null.

    Exact matches are an equi join on method and normal path, without `base`. Only calls without one are compared by
    similarity, and only with routes of their method that share a rare segment. Routes' columns get the prefix route_;
    order numbers routes.
    """
    named = routes.select(*(F.col(c).alias(f"route_{c}") for c in routes.columns))
    key, rank = f"route_{method}", f"route_{order}"
    calls = calls.withColumn("_call", F.xxhash64(*calls.columns))
    unique = calls.dropDuplicates(["_call"])
    exact = unique.join(named, (unique[method] == named[key]) & (route_key(unique[call_path], base) == route_key(named[f"route_{route_path}"], base)))
    exact = _first_route(exact, rank).withColumn("route_score", F.lit(1.0))
    rest = unique.join(exact.select("_call"), "_call", "left_anti")
    pairs = similar_segments(rest.select("_call", F.col(call_path).alias("_path"), F.col(method).alias("_method")), named.select(F.col(rank).alias("_rank"), F.col(f"route_{route_path}").alias("_path"), F.col(key).alias("_method")), threshold)
    pairs = pairs.join(rest, "_call").join(named, F.col("_rank") == F.col(rank)).where(F.col(method) == F.col(key))
    scored = pairs.withColumn("route_score", segment_similarity(call_path, f"route_{route_path}")).where(F.col("route_score") > threshold)
    fuzzy = scored.groupBy("_call").agg(F.min(F.struct((-F.col("route_score")).alias("low"), F.col(rank).alias("rank"), F.struct(*named.columns, "route_score").alias("route"))).alias("best")).select("_call", "best.route.*")
    chosen = exact.select("_call", *named.columns, "route_score").unionByName(fuzzy)
    return calls.join(chosen, "_call", "left").drop("_call")


def _first_route(pairs: DataFrame, rank: str) -> DataFrame:
    columns = [c for c in pairs.columns if c.startswith("route_")]
    return pairs.groupBy("_call").agg(F.min_by(F.struct(*columns), F.col(rank)).alias("best")).select("_call", "best.*")
