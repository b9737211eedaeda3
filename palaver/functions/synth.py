"""Synthetic text expressions: every choice is a seeded draw over the row's ids.

A ``Draws`` object carries the seed and the id columns of a row, so that a text
is a pure function of (seed, ids, salt) and does not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from palaver.functions.draws import draw, pick, uniform_int, unit, weighted_choice
from palaver.functions.text import (bind, chars, cut_at_sentence, repeat_to_length, repeat_word,
                                    sentence_case, strip_placeholders, strip_space, word_count, words)

# Repetition bounds, block weights and length bounds of the
# repetitive and random families.
REPEAT_BOUNDS = {"single_word": (5, 100), "phrase_repeat": (3, 50), "counting_repeat": (5, 30),
                 "letter_repeat": (50, 500), "sentence_repeat": (2, 20)}
MIXED_WEIGHTS = {"word": 0.4, "number": 0.25, "symbol": 0.15, "chars": 0.2}
BLOCK_WEIGHTS = {"filler": 0.35, "echo": 0.35, "list": 0.15, "numbered": 0.15}
# (low before turn 3, low from turn 3, high before turn 5, high from turn 5)
USER_BOUNDS = {"random_words": (3, 5, 15, 30), "random_chars": (10, 20, 80, 200),
               "random_sentences": (1, 2, 3, 6), "random_mixed": (5, 8, 15, 25),
               "random_lorem": (10, 15, 30, 60)}
ECHO_BOUNDS = {"random_words": (5, 20), "random_chars": (15, 80), "random_sentences": (1, 3),
               "random_mixed": (5, 15), "random_lorem": (8, 30)}
ALPHANUMERIC = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
SYMBOLS = "!@#$%^&*()_+-=[]{}|;:',.<>?/~`"
ADVERB_CHANCE, PHRASE_CHANCE, COMMA_CHANCE = 0.4, 0.5, 0.4

Bound = Column | int


@dataclass(frozen=True)
class Draws:
    """Draws bound to a row: ``d("salt", extra...)``."""

    seed: int
    ids: tuple[Column, ...]

    def __call__(self, salt: str, *extra: Column) -> Column:
        return draw(self.seed, salt, *self.ids, *extra)

    def at(self, *extra: Column) -> "Draws":
        """The same draws with further id parts."""
        return Draws(self.seed, (*self.ids, *extra))


def _steps(n: Column) -> Column:
    """0 .. n-1 as BIGINT."""
    zero = F.lit(0).cast("bigint")
    return F.when(n > 0, F.sequence(zero, n.cast("bigint") - 1)).otherwise(
        F.array().cast("array<bigint>"))


def _char_at(text: str, drawn: Column) -> Column:
    return F.substring(F.lit(text), (F.pmod(drawn, F.lit(len(text))) + 1).cast("int"), F.lit(1))


def repeated_text(topic: Column, base: Column, d: Draws) -> Column:
    """Repetitive user text: the base many times, or a pattern cut to length."""
    n = None
    for name, (low, high) in REPEAT_BOUNDS.items():
        amount = uniform_int(d("repeat"), low, high)
        n = F.when(topic == name, amount) if n is None else n.when(topic == name, amount)
    return F.when(topic == "letter_repeat", repeat_to_length(base, n)).otherwise(
        repeat_word(base, n))


def random_words(pool: Column, d: Draws, low: Bound, high: Bound) -> Column:
    n = uniform_int(d("words"), low, high)
    return F.array_join(F.transform(_steps(n), lambda i: pick(d("word", i), pool)), " ")


def random_characters(d: Draws, low: Bound, high: Bound) -> Column:
    """Alphanumeric text in chunks of 4 to 12 characters.

    A break comes before character *i* when *i* is a multiple of the current
    chunk size; each break draws a new size.
    """
    n = uniform_int(d("chars"), low, high)
    start = F.struct(F.lit("").alias("text"), uniform_int(d("chunk"), 4, 12).alias("chunk"))

    def add(acc: Column, i: Column) -> Column:
        broken = (i > 0) & (i % acc["chunk"] == 0)
        char = _char_at(ALPHANUMERIC, d("char", i))
        return F.struct(
            F.concat(acc["text"], F.when(broken, F.lit(" ")).otherwise(F.lit("")), char).alias("text"),
            F.when(broken, uniform_int(d("chunk", i), 4, 12)).otherwise(acc["chunk"]).alias("chunk"))

    return F.aggregate(_steps(n), start, add, lambda acc: acc["text"])


def random_sentences(pools: Mapping[str, Column], d: Draws, low: Bound, high: Bound) -> Column:
    """Sentences of subject, maybe adverb, verb, object, maybe a phrase."""
    n = uniform_int(d("sentences"), low, high)

    def sentence(i: Column) -> Column:
        optional = F.lit(None).cast("string")
        parts = F.array(
            pick(d("subject", i), pools["subjects"]),
            F.when(unit(d("has_adverb", i)) < ADVERB_CHANCE,
                   pick(d("adverb", i), pools["adverbs"])).otherwise(optional),
            pick(d("verb", i), pools["verbs"]), pick(d("object", i), pools["objects"]),
            F.when(unit(d("has_phrase", i)) < PHRASE_CHANCE,
                   pick(d("phrase", i), pools["phrases"])).otherwise(optional))
        return F.concat(F.array_join(parts, " "), F.lit("."))

    return F.array_join(F.transform(_steps(n), sentence), " ")


def random_mixed(pool: Column, d: Draws, low: Bound, high: Bound) -> Column:
    """Words, numbers in several formats, symbols and short character runs."""
    n = uniform_int(d("parts"), low, high)

    def number(i: Column) -> Column:
        form, drawn = F.pmod(d("format", i), F.lit(4)), d("number", i)
        real = F.lit(-1000.0) + F.lit(2000.0) * unit(drawn)
        digits = F.pmod(d("digits", i), F.lit(6)) + 1
        shown = F.format_string("%.6f", real)
        for k in range(5, 0, -1):
            shown = F.when(digits == k, F.format_string(f"%.{k}f", real)).otherwise(shown)
        code = F.concat(F.lit("0x"), F.lpad(F.hex(F.pmod(drawn, F.lit(0x1000000))), 6, "0"))
        return (F.when(form == 0, uniform_int(drawn, 0, 9999).cast("string"))
                .when(form == 1, shown).when(form == 2, code)
                .otherwise(uniform_int(drawn, 100_000, 99_999_999).cast("string")))

    def run(alphabet: str, salt: str, i: Column, least: int, most: int) -> Column:
        size = uniform_int(d(salt + "_n", i), least, most)
        return F.array_join(F.transform(
            _steps(size), lambda j: _char_at(alphabet, d(salt, i, j))), "")

    def part(i: Column) -> Column:
        kind = weighted_choice(d("kind", i), MIXED_WEIGHTS)
        return (F.when(kind == "word", pick(d("word", i), pool))
                .when(kind == "number", number(i))
                .when(kind == "symbol", run(SYMBOLS, "symbol", i, 1, 4))
                .otherwise(run(ALPHANUMERIC, "run", i, 3, 10)))

    return F.array_join(F.transform(_steps(n), part), " ")


def random_lorem(pool: Column, d: Draws, low: Bound, high: Bound) -> Column:
    """Pseudo-prose: words cut into sentences of 4 to 12, some with a comma."""
    n = uniform_int(d("words"), low, high)
    text = F.transform(_steps(n), lambda i: pick(d("word", i), pool))
    # A sentence has at least four words, which bounds their number.
    drawn = F.transform(_steps(F.ceil(n / 4)), lambda s: uniform_int(d("length", s), 4, 12))

    def build(parts: Column) -> Column:
        text, lengths = parts["text"], parts["lengths"]

        def span(s: Column) -> Column:
            start = F.aggregate(F.slice(lengths, F.lit(1), s.cast("int")), F.lit(0).cast("bigint"),
                                lambda total, x: total + x)
            return bind(start, lambda at: F.struct(
                s.alias("s"), at.alias("start"),
                F.least(F.element_at(lengths, (s + 1).cast("int")), n - at).alias("size")))

        def sentence(x: Column) -> Column:
            s, size = x["s"], x["size"]
            piece = F.slice(text, (x["start"] + 1).cast("int"), size.cast("int"))
            comma = F.when((size > 5) & (unit(d("has_comma", s)) < COMMA_CHANCE),
                           uniform_int(d("comma", s), F.lit(2).cast("bigint"), size - 2)
                           ).otherwise(F.lit(-1).cast("bigint"))
            return bind(comma, lambda at: sentence_case(piece, at))

        spans = F.filter(F.transform(_steps(F.size(lengths).cast("bigint")), span),
                         lambda x: x["size"] > 0)
        return F.array_join(F.transform(spans, sentence), " ")

    return bind(F.struct(text.alias("text"), drawn.alias("lengths")), build)


def random_text(topic: Column, pools: Mapping[str, Column], d: Draws,
                bounds: Mapping[str, tuple[Bound, Bound]]) -> Column:
    """Text of the topic's kind with bounds per kind; unknown topics give words."""
    build = {
        "random_chars": lambda lo, hi: random_characters(d, lo, hi),
        "random_sentences": lambda lo, hi: random_sentences(pools, d, lo, hi),
        "random_mixed": lambda lo, hi: random_mixed(pools["words"], d, lo, hi),
        "random_lorem": lambda lo, hi: random_lorem(pools["lorem"], d, lo, hi),
    }
    out = random_words(pools["words"], d, *bounds["random_words"])
    for name, make in build.items():
        out = F.when(topic == name, make(*bounds[name])).otherwise(out)
    return out


def user_bounds(turn: Column) -> dict[str, tuple[Column, Column]]:
    """User texts grow with the turn: limits change at turns 3 and 5."""
    def big(x: int) -> Column:
        return F.lit(x).cast("bigint")

    return {name: (F.when(turn < 3, big(a)).otherwise(big(b)),
                   F.when(turn < 5, big(c)).otherwise(big(e)))
            for name, (a, b, c, e) in USER_BOUNDS.items()}


def random_reply(topic: Column, pools: Mapping[str, Column], d: Draws, target: Column) -> Column:
    """Filler, echo, bullet and numbered blocks until ``target`` words are there.

    Blocks are separated by blank lines; a text well over the target is cut.
    """
    def block(i: Column) -> Column:
        at = d.at(i)
        kind = weighted_choice(at("block"), BLOCK_WEIGHTS)
        bullets = F.transform(
            _steps(uniform_int(at("items"), 3, 6)),
            lambda j: F.concat(F.lit("- "), random_words(pools["words"], at.at(j), 3, 8)))
        numbered = F.transform(
            _steps(uniform_int(at("points"), 2, 5)),
            lambda j: F.concat((j + 1).cast("string"), F.lit(". "),
                               pick(at("point", j), pools["fillers"])))
        return (F.when(kind == "filler", pick(at("filler"), pools["fillers"]))
                .when(kind == "echo", random_text(topic, pools, at, ECHO_BOUNDS))
                .when(kind == "list", F.array_join(bullets, "\n"))
                .otherwise(F.array_join(numbered, "\n")))

    def counted(text: Column, kind: Column) -> Column:
        # List markers do not count as words.
        lines = F.size(F.split(text, "\n")).cast("bigint")
        return word_count(text) - F.when(kind.isin("list", "numbered"), lines).otherwise(
            F.lit(0).cast("bigint"))

    start = F.struct(F.array().cast("array<string>").alias("parts"),
                     F.lit(0).cast("bigint").alias("n"))

    def add(acc: Column, i: Column) -> Column:
        kind = weighted_choice(d.at(i)("block"), BLOCK_WEIGHTS)
        grown = bind(F.coalesce(block(i), F.lit("")), lambda text: F.struct(
            F.concat(acc["parts"], F.array(text)).alias("parts"),
            (acc["n"] + counted(text, kind)).alias("n")))
        return F.when(acc["n"] < target, grown).otherwise(acc)

    # Every block has a word, so ``target`` blocks are always enough.
    joined = F.aggregate(_steps(target), start, add, lambda acc: F.array_join(acc["parts"], "\n\n"))
    return bind(joined, lambda text: F.when(
        word_count(text) > target * F.lit(1.3), cut_at_sentence(text, target)).otherwise(text))


def shuffled_pool(pool: Column, d: Draws) -> Column:
    """The pool in a seeded order of the row."""
    placed = F.transform(pool, lambda x, i: F.struct(
        d("shuffle", i).alias("drawn"), i.alias("at"), x.alias("value")))
    return F.transform(F.array_sort(placed), lambda x: x["value"])


def extension_words(pool: Column, d: Draws, missing: Column, use_up: bool = False) -> Column:
    """Words of whole extension sentences, drawn until ``missing`` are there.

    With ``use_up`` the pool is walked in a seeded order first; draws follow when it
    is at its end.
    """
    none = F.array().cast("array<string>")
    zero = F.lit(0).cast("bigint")

    # An aggregate copies what it holds at every step, so it only counts: words and sentences.
    def enough(drawn: Column) -> Column:
        return F.aggregate(
            drawn, F.struct(zero.alias("words"), zero.alias("sentences")),
            lambda acc, s: F.when(acc["words"] < missing, F.struct(
                (acc["words"] + F.size(s)).alias("words"),
                (acc["sentences"] + 1).alias("sentences"))).otherwise(acc),
            lambda acc: acc["sentences"].cast("int"))

    def walk(told: Column, order: Column | None = None) -> Column:
        def sentence(i: Column) -> Column:
            drawn = pick(d("extension", i), told)
            if order is not None:
                drawn = F.when(i < F.size(order), F.get(order, i.cast("int"))).otherwise(drawn)
            return F.coalesce(drawn, none)

        least = F.greatest(F.lit(1), F.array_min(F.transform(told, F.size)))
        return bind(F.transform(_steps(F.ceil(missing / least)), sentence),
                    lambda drawn: F.flatten(F.slice(drawn, F.lit(1), enough(drawn))))

    def spoken(told: Column) -> Column:
        return bind(shuffled_pool(told, d), lambda order: walk(told, order)) if use_up else walk(told)

    return bind(F.transform(pool, lambda s: F.coalesce(words(s), none)), spoken)


def render(template: Column, fills: Mapping[str, Column], pools: Mapping[str, Column], d: Draws,
           one_draw_per_key: bool = False, letters_only: bool = False,
           numbers: Mapping[str, tuple[int, int]] | None = None, passes: int = 2) -> Column:
    """Fill ``{key}`` markers: row values first, then pool draws, then clean up.

    Each occurrence of a pool key gets its own draw, unless
    ``one_draw_per_key``.  Pool values may hold markers, which the next of the
    ``passes`` fills.  ``numbers`` are keys for a whole number between two
    bounds.  Unknown markers are removed, and white space around the text.
    """
    out = template
    for name, value in fills.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    for turn in range(passes):
        for name, pool in pools.items():
            salt = name if turn == 0 else f"{name}+{turn}"
            if one_draw_per_key:
                out = F.replace(out, F.lit("{" + name + "}"),
                                F.coalesce(pick(d(salt), pool), F.lit("")))
            else:
                out = _fill_each(out, name, salt, pool, d)
    for name, (low, high) in (numbers or {}).items():
        out = F.replace(out, F.lit("{" + name + "}"),
                        uniform_int(d("number", F.lit(name)), low, high).cast("string"))
    return strip_space(strip_placeholders(out, letters_only))


def _fill_each(text: Column, name: str, salt: str, pool: Column, d: Draws) -> Column:
    """Replace every occurrence of one marker by its own draw."""
    def joined(piece: Column, i: Column) -> Column:
        drawn = F.coalesce(pick(d(salt, i), pool), F.lit(""))
        return F.concat(F.when(i > 0, drawn).otherwise(F.lit("")), piece)

    return F.array_join(F.transform(F.split(text, r"\{" + name + r"\}", -1), joined), "")


def repeat_reply(topic: Column, template: Column, base: Column, user_text: Column) -> Column:
    """Reply about a repetition: how often the base occurs, or how long the text is."""
    count = F.coalesce(F.call_function(
        "div", chars(user_text) - chars(F.replace(user_text, base, F.lit(""))),
        F.greatest(F.lit(1).cast("bigint"), chars(base))), F.lit(0)).cast("string")
    out = template
    for name in ("word", "phrase", "sequence", "pattern", "sentence"):
        out = F.replace(out, F.lit("{" + name + "}"), base)
    out = F.replace(out, F.lit("{count}"), count)
    return F.replace(out, F.lit("{length}"), chars(user_text).cast("string"))


def fixed_pool(values: Sequence[str]) -> Column:
    """A configured list as an array column."""
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")
