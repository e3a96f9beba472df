"""Tokens, phrases and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of letters, digits and underscores in any script.
TOKEN = r"[\p{L}\p{N}_]+"

# Fixed values of the feed's display.
PERMALINK_PREFIX = "http://reddit.com"
URL_CHARS = 28
HIGHLIGHT_OPEN = "<span class='highlight'>"
HIGHLIGHT_CLOSE = "</span>"


def tokens(text: Column | str) -> Column:
    """Lower-case tokens of ``text`` in order; empty array when there are none."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def phrase(text: Column | str) -> Column:
    """``text`` reduced to its tokens, joined by single blanks."""
    return F.array_join(tokens(text), " ")


def contains_phrase(text_phrase: Column | str, sought: Column | str) -> Column:
    """True when the tokens of ``sought`` stand together, in order, in the text.

    Both sides are already reduced by :func:`phrase`. The blanks around them
    make it a match of whole tokens: ``ork`` is not found in ``york``.
    """
    blank = F.lit(" ")
    return F.contains(F.concat(blank, text_phrase, blank), F.concat(blank, sought, blank))


def grams(token_column: str, n: int) -> Column:
    """Every run of ``n`` tokens, one array entry per starting position.

    ``token_column`` names a column, so that the tokens are computed once and
    only looked up here. Positions too close to the end yield NULL.
    """
    if n == 1:
        return F.col(token_column)

    def run(first: Column, i: Column) -> Column:
        parts = [first]
        for step in range(1, n):
            parts += [F.lit(" "), F.get(token_column, i + step)]
        return F.concat(*parts)

    return F.transform(token_column, run)


def highlight(title: Column | str, topic: Column | str) -> Column:
    """Mark the first, case-sensitive occurrence of ``topic`` in ``title``."""
    title, topic = _col(title), _col(topic)
    start = F.position(topic, title)
    after = start + F.length(topic)
    marked = F.concat(
        F.substring(title, F.lit(1), start - 1),
        F.lit(HIGHLIGHT_OPEN), topic, F.lit(HIGHLIGHT_CLOSE),
        F.substring(title, after, F.length(title)),
    )
    return F.when(start > 0, marked).otherwise(title)


def short_url(url: Column | str, chars: int = URL_CHARS) -> Column:
    """The first ``chars`` characters, with ``...`` when something was cut off."""
    url = _col(url)
    return F.when(F.length(url) > chars,
                  F.concat(F.substring(url, 1, chars), F.lit("..."))).otherwise(url)


def absolute_link(permalink: Column | str, prefix: str = PERMALINK_PREFIX) -> Column:
    return F.concat(F.lit(prefix), permalink)


def split_topics(topic_list: Column | str, trim: bool = False) -> Column:
    """Topics of a comma-separated list; blanks are kept unless ``trim``."""
    parts = F.split(topic_list, ",")
    return F.transform(parts, lambda topic: F.trim(topic)) if trim else parts


def has_text(value: Column | str) -> Column:
    """False for an empty string, NULL for NULL: as a filter, drops both."""
    return F.length(value) > 0


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
