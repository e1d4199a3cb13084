"""Fields out of stored HTML pages, with Spark expressions; nested markup through one small parser."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Named character references that the expressions decode, with or without the closing semicolon;
# ``amp`` last, so that no text is decoded twice.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "nbsp": " ", "copy": "©", "middot": "·", "amp": "&"}


def _column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def unescape(column) -> Column:
    column = _column(column)
    for name, character in ENTITIES.items():
        column = F.regexp_replace(column, f"&{name};?", character)
    return column


def tag_text(html, tag: str, default: str) -> Column:
    """Trimmed text of the first ``tag`` element without markup, the default when absent."""
    html = _column(html)
    pattern = rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"
    inner = F.regexp_replace(F.regexp_extract(html, pattern, 1), r"<[^>]*>", "")
    return F.when(html.rlike(pattern), F.trim(unescape(inner))).otherwise(F.lit(default))


def links(html) -> Column:
    """Targets of all anchors, in page order."""
    return F.regexp_extract_all(_column(html), F.lit(r'<a\s[^>]*?href="([^"]*)"'), F.lit(1))


def readable_text(html, max_chars: int | None = None) -> Column:
    """Page text without script, style, superscript and tables, white space collapsed.

    The whole text by default; ``max_chars`` gives the leading part for a short preview.
    """
    column = _column(html)
    for tag in ("script", "style", "sup", "table"):
        column = F.regexp_replace(column, rf"(?s)<{tag}(\s[^>]*)?>.*?</{tag}>", " ")
    column = F.regexp_replace(column, r"(?s)<!--.*?-->", " ")
    column = F.regexp_replace(column, r"<[^>]*>", " ")
    column = F.trim(F.regexp_replace(unescape(column), r"\s+", " "))
    return F.substring(column, 1, max_chars) if max_chars else column


def list_items(df: DataFrame, html: str, *keys: str) -> DataFrame:
    """One row per ``li``: position, anchor text as name, and image captions as tokens."""
    items = F.regexp_extract_all(F.col(html), F.lit(r"(?s)<li(?:\s[^>]*)?>(.*?)</li>"), F.lit(1))
    caption = F.regexp_extract_all(F.col("item"), F.lit(r'<img\s[^>]*?alt="([^"]*)"'), F.lit(1))
    return (
        df.select(*keys, F.posexplode(items).alias("position", "item"))
        .select(
            *keys, (F.col("position") + 1).cast("bigint").alias("position"),
            tag_text("item", "a", "").alias("name"),
            F.filter(F.transform(caption, lambda t: F.trim(t)), lambda t: t != "").alias("tokens"),
        )
    )


def element_text(df: DataFrame, key: str, html: str, tag: str, wanted: dict[str, str], default: str) -> DataFrame:
    """Text of the first ``tag`` element having the ``wanted`` attributes, nested markup included.

    A pattern cannot pair nested elements of one name, so the standard library's parser reads
    each page; pages stay independent rows and no shuffle takes place.
    """
    kind = df.schema[key].dataType.simpleString()

    def parse(batches: Iterator) -> Iterator:
        import re
        from html.parser import HTMLParser

        class Reader(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.depth, self.parts, self.done, self.skip = 0, [], False, 0

            def handle_starttag(self, name, attributes):
                if name in ("script", "style"):
                    self.skip += 1
                if self.depth and name == tag:
                    self.depth += 1
                elif not self.depth and not self.done and name == tag:
                    present = dict(attributes)
                    if all(present.get(k) == v for k, v in wanted.items()):
                        self.depth = 1

            def handle_endtag(self, name):
                if name in ("script", "style") and self.skip:
                    self.skip -= 1
                if self.depth and name == tag:
                    self.depth -= 1
                    self.done = self.depth == 0

            def handle_data(self, data):
                if self.depth and not self.skip:
                    self.parts.append(data)

        def text_of(page):
            reader = Reader()
            reader.feed(page or "")
            reader.close()
            found = reader.done or reader.depth
            return re.sub(r"\s+", " ", "".join(reader.parts)).strip() if found else default

        for batch in batches:
            yield batch[[key]].assign(body=[text_of(page) for page in batch[html]])

    return df.select(key, html).mapInPandas(parse, f"{key} {kind}, body string")


def fields_by_selector(df: DataFrame, key: str, html: str, fields: dict[str, tuple]) -> DataFrame:
    """``key`` and one string column per field: (selector, attribute or None for the text, default, separator or None for the first only).

    A selector is steps with white space between them, each inside the one before it at any depth; a step is a tag or ``*``, ``.class``, ``#id``,
    ``[attribute]`` or ``[attribute="value"]``, or several of them together. Text is that of the element and all in it but scripts and
    styles, white space collapsed. An element without the attribute is passed over; the default stands where nothing is left, and for null
    pages. A page is read once for all fields and pages are independent rows, so there is no shuffle.
    """
    import re

    part = re.compile(r"""(?P<tag>[\w-]+|\*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<name>[\w:-]+)(?:=["']?(?P<value>[^"'\]]*)["']?)?\]""")

    def step(text: str) -> tuple:
        tests, at = [], 0
        while at < len(text):
            found = part.match(text, at)
            if found is None or found["tag"] and at:
                raise ValueError(f"not a selector: {text}")
            tests.append((found.lastgroup if found["name"] is None else "name", found["tag"] or found["cls"] or found["id"] or found["name"], found["value"]))
            at = found.end()
        return tuple(tests)

    # White space inside quotes does not part steps.
    wanted = [(tuple(step(s) for s in re.findall(r"""(?:\[[^\]]*\]|\S)+""", selector)), attribute, default, separator)
              for selector, attribute, default, separator in fields.values()]
    if not all(steps for steps, *_ in wanted):
        raise ValueError("a selector has at least one step")
    names, kind = list(fields), df.schema[key].dataType.simpleString()

    def parse(batches: Iterator) -> Iterator:
        from html.parser import HTMLParser

        void = frozenset("area base br col embed hr img input link meta source track wbr".split())

        def fits(tests, element) -> bool:
            tag, attributes = element
            for what, name, value in tests:
                if what == "tag":
                    good = name in ("*", tag)
                elif what == "cls":
                    good = name in (attributes.get("class") or "").split()
                elif what == "id":
                    good = attributes.get("id") == name
                else:
                    good = name in attributes and (value is None or (attributes[name] or "") == value)
                if not good:
                    return False
            return True

        class Reader(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.stack, self.open, self.found = [], [], [[] for _ in wanted]

            def handle_starttag(self, tag, attributes):
                element = tag, dict(attributes)
                for number, (steps, attribute, _, separator) in enumerate(wanted):
                    if (separator is None and self.found[number]) or not fits(steps[-1], element):
                        continue
                    # The innermost ancestor for the last step, the next one out for the step before it.
                    left = len(steps) - 1
                    for outer in reversed(self.stack):
                        if left and fits(steps[left - 1], outer):
                            left -= 1
                    if left or attribute is not None and attribute not in element[1]:
                        continue
                    parts = [] if attribute is None else [element[1][attribute] or ""]
                    self.found[number].append(parts)
                    if attribute is None and tag not in void:
                        self.open.append((len(self.stack), parts))
                if tag not in void:
                    self.stack.append(element)

            def handle_startendtag(self, tag, attributes):
                self.handle_starttag(tag, attributes)
                if tag not in void:
                    self.handle_endtag(tag)

            def handle_endtag(self, tag):
                # An element that was left open ends with the one around it; an end without a beginning is nothing.
                at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
                if at is not None:
                    del self.stack[at:]
                    self.open = [(depth, parts) for depth, parts in self.open if depth < at]

            def handle_data(self, data):
                if self.open and self.stack[-1][0] not in ("script", "style"):
                    for _, parts in self.open:
                        parts.append(data)

        def fields_of(page):
            reader = Reader()
            reader.feed(page or "")
            reader.close()
            values = ([re.sub(r"\s+", " ", "".join(parts)).strip() if attribute is None else parts[0] for parts in found]
                      for found, (_, attribute, _, _) in zip(reader.found, wanted))
            return [(separator or "").join(found) if found else default for found, (_, _, default, separator) in zip(values, wanted)]

        for batch in batches:
            rows = [fields_of(page) for page in batch[html]]
            yield batch[[key]].assign(**{name: [row[i] for row in rows] for i, name in enumerate(names)})

    return df.select(key, html).mapInPandas(parse, f"`{key}` {kind}, " + ", ".join(f"`{name}` string" for name in names))
