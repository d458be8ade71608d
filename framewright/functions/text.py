"""Column functions on captions, tags, names and markup. None of them shuffles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The quality labels that a score folder stands for.
SCORE_LABELS = {
    "score_9": ["score_7_up", "score_8_up", "score_9"],
    "score_8": ["score_7_up", "score_8_up"],
    "score_7": ["score_6_up", "score_7_up"],
    "score_6": ["score_4_up", "score_5_up", "score_6_up"],
    "score_5": ["score_4_up", "score_5_up"],
    "score_4": ["score_4_up"],
}


#: The score phrases that captions lose first, in this order.
SCORE_PHRASES = ("score_9,", "score_8_up,", "score_7_up,", "score_6_up,", "score_5_up,", "score_4_up,")


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, where it is named in several places."""
    return F.get(F.transform(F.array(value), then), 0)


def uniform(seed: int, *keys) -> Column:
    """A number in [0, 1) from a hash of the seed and keys: the same in every run and partitioning."""
    digest = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in keys))), 1, 8)
    return F.conv(digest, 16, 10).cast("double") / F.lit(4294967296.0)


def py_strip(c: Column) -> Column:
    """Strips every kind of Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def pieces(c: Column, sep: str = ",") -> Column:
    return F.transform(F.split(c, sep), py_strip)


def remove_brackets(c: Column) -> Column:
    """Drops bracket marks and keeps the text inside, parentheses first; pairs don't span lines."""
    return F.regexp_replace(F.regexp_replace(c, r"(?d)\((.*?)\)", "$1"), r"(?d)\[(.*?)\]", "$1")


def remove_substring_tags(c: Column) -> Column:
    """Drops every tag that is part of a different tag; exact repeats stay."""
    # the lists are bound once; named twice, they would be split anew for every tag
    listed = lambda tags: F.struct(tags.alias("all"), F.array_distinct(tags).alias("each"))
    alone = lambda s: F.filter(s["all"], lambda x: ~F.exists(s["each"], lambda y: y.contains(x) & (y != x)))
    return F.array_join(bound(pieces(c), lambda tags: bound(listed(tags), alone)), ", ")


def drop_tags_randomly(c: Column, key: Column, trigger_rate: float = 0.3, drop_chance: float = 0.6, seed: int = 0, empty_text: str = "cartoon") -> Column:
    """With ``trigger_rate``, keeps each tag with a chance of 1 - ``drop_chance``; never empties a caption."""

    def thinned(text: Column) -> Column:
        kept = F.filter(F.split(text, ", "), lambda x, i: uniform(seed, key, i) > drop_chance)
        return bound(kept, lambda tags: F.when(F.size(tags) > 0, F.array_join(tags, ", ")).otherwise(text))

    return bound(c, lambda text: F.when(text == "", empty_text).when(uniform(seed, key) > trigger_rate, text).otherwise(thinned(text)))


def expand_scores(folders: Column) -> Column:
    table = F.create_map(*(x for k, v in SCORE_LABELS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return F.flatten(F.transform(folders, lambda x: F.coalesce(F.try_element_at(table, x), F.array(x))))


def replace_phrases(c: Column, mapping: Mapping[str, str] | None = None) -> Column:
    """Literal replacements one after the other, in the order given."""
    for old, new in (mapping or {}).items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def remove_phrases(c: Column, banned: Sequence[str] = (), scores: Sequence[str] = SCORE_PHRASES) -> Column:
    """Without the score phrases, then without the banned ones, each in the order given."""
    return replace_phrases(c, dict.fromkeys((*scores, *banned), ""))


def folder_labels(rel_dir: Column) -> Column:
    """Names of the folders of a path without their repeat counts; the root is ``.``."""
    parts = F.transform(F.split(rel_dir, "/"), lambda x: F.regexp_replace(x, r"^\d+_", ""))
    return F.when((rel_dir == "") | (rel_dir == "."), F.array(F.lit("."))).otherwise(parts)


def label_prefix(labels: Column, mode: str = "all") -> Column:
    """Labels in reverse, without the neutral ones, as the start of a caption."""
    chosen = {"last_only": F.slice(labels, -1, 1), "all_score": expand_scores(labels), "all": labels}[mode]
    left = F.reverse(F.filter(chosen, lambda x: ~x.isin("other", "0other", "minor")))
    return F.when(F.size(left) > 0, F.concat(F.array_join(left, ", "), F.lit(", "))).otherwise("")


def label_caption(text: Column, rel_dir: Column, key: Column, mode: str = "all", rate: float = 0.3, chance: float = 0.6, seed: int = 0, phrases: Mapping[str, str] | None = None) -> Column:
    """A clean caption behind its folders' labels; captions below ``0other`` keep all tags."""
    labels, plain = folder_labels(rel_dir), remove_brackets(text)
    thinned = drop_tags_randomly(remove_substring_tags(plain), key, rate, chance, seed)
    body = F.when(F.array_contains(labels, "0other"), plain).otherwise(thinned)
    return F.concat(label_prefix(labels, mode), replace_phrases(body, phrases))


def strip_repeat_prefix(name: Column) -> Column:
    bare = F.regexp_replace(name, r"^\d+_", "")
    return F.when(bare == "", name).otherwise(bare)


def caption_from_meta(meta: Column, keys: Sequence[str]) -> Column:
    """Values of the keys joined by a comma; a missing one leaves its comma."""
    return py_strip(F.array_join(F.array(*(F.coalesce(F.try_element_at(meta, F.lit(k)), F.lit("")) for k in keys)), ", "))


def upsert_meta(meta: Column, key: str, text: Column) -> Column:
    """``meta`` with the stripped text under the key; a null map becomes one with that entry only."""
    new = F.create_map(F.lit(key), py_strip(text))
    return F.when(meta.isNull(), new).otherwise(F.map_concat(F.map_filter(meta, lambda k, _: k != key), new))


def strip_markup(c: Column) -> Column:
    return F.regexp_replace(c, r"(?d)<.*?>", "")


def caption_from_filename(stem: Column, text: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(stem, "-")), ", "), F.lit(", "), py_strip(text))


def strip_name_prefix(name: Column, prefix: str = "cropped_") -> Column:
    return F.when(name.startswith(prefix), F.substring(name, len(prefix) + 1, 1 << 30)).otherwise(name)


def caption_kind_name(stem: Column, suffix: str) -> Column:
    return F.concat(stem, F.lit(suffix + ".txt"))


def merge_tag_lists(existing: Column, new: Column, sep: str = ",") -> Column:
    """The old tags, then the new ones that aren't among them; order and repeats stay."""
    old = F.filter(pieces(existing, sep.strip()), lambda x: x != "")
    return F.array_join(F.concat(old, F.filter(new, lambda x: ~F.array_contains(old, x))), sep)


def frame_name(video_idx: Column, frame: Column) -> Column:
    return F.format_string("f_%08d.png", (video_idx * 1_000_000 + frame).cast("long"))


def extension(filename: Column) -> Column:
    """From the last dot; names that begin with their only dots have none."""
    return F.regexp_extract(filename, r"^.*[^.].*(\.[^.]*)$", 1)


def html_links(html: Column, attribute: tuple[str, str] | None = None, ext: str | None = None) -> Column:
    """(href, text) of the anchors; the href without slashes at its ends, empty ones left out.

    Only those with the ``attribute`` (name, value), and whose href ends with ``ext``, such as ``.png``.
    The text is without markup and white space at its ends.
    """
    anchor = r"(?s)(<a\s[^>]*>)(.*?)</a>"
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(anchor), 1).alias("tag"), F.regexp_extract_all(html, F.lit(anchor), 2).alias("text"))
    if attribute:
        pairs = F.filter(pairs, lambda p: p["tag"].rlike(rf'\s{attribute[0]}="{attribute[1]}"'))
    href = lambda p: F.regexp_replace(F.regexp_extract(p["tag"], r'\shref="([^"]*)"', 1), "^/+|/+$", "")
    stripped = F.transform(pairs, lambda p: F.struct(href(p).alias("href"), py_strip(F.regexp_replace(p["text"], "(?s)<[^>]*>", "")).alias("text")))
    return F.filter(stripped, lambda p: (p.href != "") & p.href.endswith(ext or ""))


def html_heading(html: Column, tag: str = "h1", scope_class: str | None = None) -> Column:
    """The first heading (inside the element of a class), stripped; null if there's none."""
    scope = rf'class="[^"]*\b{scope_class}\b[^"]*".*?' if scope_class else ""
    return F.nullif(py_strip(F.regexp_extract(html, rf"(?s){scope}<{tag}\b[^>]*>(.*?)</{tag}>", 1)), F.lit(""))


def html_images(html: Column, article_class: str | None = None) -> Column:
    """(src, id) of the matching articles (all without a class) that have an image with a source.

    Ids are without ``#`` at their ends, dots as underscores; ``unknown`` where there's none.
    """
    scope = rf'[^>]*class="[^"]*\b{article_class}\b[^"]*"' if article_class else r"\b"
    articles = F.regexp_extract_all(html, F.lit(rf"(?s)<article{scope}[^>]*>(.*?)</article>"), 1)

    def image(a: Column) -> Column:
        own = F.replace(F.trim(F.regexp_extract(a, r'(?s)class="[^"]*sprite-id[^"]*"[^>]*>\s*(.*?)\s*<', 1), F.lit("#")), F.lit("."), F.lit("_"))
        return F.struct(F.regexp_extract(a, r'(?s)<img[^>]*src="([^"]*)"', 1).alias("src"), F.when(own == "", "unknown").otherwise(own).alias("id"))

    return F.filter(F.transform(articles, image), lambda x: x.src != "")


def absolute_url(base: str, href: Column) -> Column:
    root = "/".join(base.split("/")[:3])
    return F.when(href.rlike("^https?://"), href).when(href.startswith("/"), F.concat(F.lit(root), href)).otherwise(F.concat(F.lit(base.rsplit("/", 1)[0] + "/"), href))
