"""Table and part names as Column expressions."""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column, functions as F

# Accepted form of a table name in a manifest.
FQN_PATTERN = r"^\[[^\[\]\x00-\x1f\x7f]+\]\.\[[^\[\]\x00-\x1f\x7f]+\]$"
DATABASE_NAME_PATTERN = r"^\w{1,128}$"
SYSTEM_DATABASES = ("master", "model", "msdb", "tempdb", "default", "information_schema")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def column(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh(taken, *wanted: str) -> list[str]:
    """Working names that no column in ``taken`` has, in any case."""
    used = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def quote_ident(name) -> Column:
    """``a]b`` -> ``[a]]b]``."""
    return F.concat(F.lit("["), F.replace(_col(name), F.lit("]"), F.lit("]]")), F.lit("]"))


def qualified_name(schema, table) -> Column:
    return F.concat(quote_ident(schema), F.lit("."), quote_ident(table))


def sql_literal_body(text) -> Column:
    """Text safe inside a single-quoted literal."""
    return F.replace(_col(text), F.lit("'"), F.lit("''"))


def file_stem(fqn) -> Column:
    """``[dbo].[Orders]`` -> ``dbo_Orders``. Distinct tables can share a stem; see ``stem_collisions``."""
    plain = F.translate(_col(fqn), "[]", "")
    return F.btrim(F.replace(plain, F.lit("."), F.lit("_")), F.lit("_"))


def part_path(fqn, part=None) -> Column:
    """Path of a whole table (``part`` is None) or of one of its parts inside a bundle."""
    if part is None:
        return F.concat(F.lit("data/"), file_stem(fqn), F.lit(".parquet"))
    return F.concat(
        F.lit("data/"), file_stem(fqn), F.lit(".part"), _col(part).cast("string"), F.lit(".parquet")
    )


def is_valid_fqn(fqn) -> Column:
    return F.coalesce(_col(fqn).rlike(FQN_PATTERN.replace("$", r"\z")), F.lit(False))


def make_fqn(schema: str, table: str) -> str:
    return ".".join("[" + part.replace("]", "]]") + "]" for part in (schema, table))


def split_fqn(fqn: str) -> tuple[str, str]:
    if not re.fullmatch(FQN_PATTERN, fqn):
        raise ValueError(f"not a [schema].[table] name: {fqn!r}")
    schema, table = fqn[1:-1].split("].[")
    return schema, table


def table_dir(fqn: str) -> str:
    """Folder name of a table in a bundle: reversible, so two tables never share one."""
    def encode(part: str) -> str:
        # quote() leaves . _ ~ alone: the first two mark hidden folders, the last is our escape
        text = quote(part, safe="").replace("~", "%7E").replace(".", "%2E")
        if text.startswith("_"):
            text = "%5F" + text[1:]
        return text.replace("%", "~")

    return ".".join(encode(part) for part in split_fqn(fqn))


def names_of(tables: dict) -> dict:
    """Tables by ``schema.table``, and by the bare name where only one schema has it."""
    names = [(*split_fqn(fqn), df) for fqn, df in tables.items()]
    bare = [table for _, table, _ in names]
    out = {f"{schema}.{table}": df for schema, table, df in names}
    return out | {table: df for _, table, df in names if bare.count(table) == 1}


def check_database_name(name: str) -> str:
    """Guard in front of a drop: plain word characters only, never a system database."""
    if not re.fullmatch(DATABASE_NAME_PATTERN, name, flags=re.ASCII):
        raise ValueError(f"invalid database name {name!r}")
    if name.lower() in SYSTEM_DATABASES:
        raise ValueError(f"refusing to replace {name!r}")
    return name


def glob_to_regex(pattern: str) -> str:
    """Shell glob (``*``, ``?``, ``[a-z]``, ``[!a]``) as an anchored regex; bad patterns raise."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out.append("(?s:.*)")
        elif ch == "?":
            out.append("(?s:.)")
        elif ch == "[":
            end = pattern.find("]", i + 3 if pattern[i + 1:i + 2] == "!" else i + 2)
            if end < 0:
                raise ValueError(f"unclosed [ in glob {pattern!r}")
            body = pattern[i + 1:end]
            negate, body = (body[:1] == "!"), body.removeprefix("!")
            # a dash is a range only between two characters
            escaped = re.sub(r"([\\\[\]^&])", r"\\\1", body)
            escaped = re.sub(r"^-|-$", r"\\-", escaped)
            out.append("[" + ("^" if negate else "") + escaped + "]")
            i = end
        else:
            out.append(re.escape(ch))
        i += 1
    return r"\A" + "".join(out) + r"\z"
