"""Decisions stated as rule tables: a rule names the facts that must all hold, and of the rules
that apply to a row the first one in order gives its label."""


def first_rule(name: str, source: str, line: str, facts: dict[str, str], rules: list[tuple[str, str]]) -> str:
    """CTEs `{name}` (line, label) over the rows of `source`, told apart by `line`. facts: what each
    word means on a row; rules: (words, label as SQL), in order of precedence."""
    holds = ", ".join(f"CASE WHEN {sql} THEN '{word}' END" for word, sql in facts.items())
    table = ", ".join(f"({place}, {words.split()!r}::VARCHAR[], {label})" for place, (words, label) in enumerate(rules, 1))
    return f"""
{name}_rules(place, words, label) AS (VALUES {table}),
{name} AS (
    SELECT line, arg_min(label, place) AS label
    FROM (SELECT {line} AS line, [{holds}] AS holds FROM {source}) JOIN {name}_rules ON list_has_all(holds, words)
    GROUP BY line)"""


def day(d) -> str:
    return f"DATE '{d.isoformat()}'"


def month_of(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


def any_like(column: str, patterns: list[str]) -> str:
    """Whether the lower-cased text matches one of the patterns; NULL for no text."""
    return f"list_bool_or([lower({column}) LIKE p FOR p IN {patterns!r}])"
