"""The operators' expressions in DuckDB's SQL, for the oracles of the catalog."""

from __future__ import annotations

from ..functions import vocab as V
from ..functions.rules import Rule
from ..functions.text import SPACES
from ..operators.variants import kinds


def q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def lst(values: list[str]) -> str:
    return "[" + ", ".join(map(q, values)) + "]" if values else "CAST([] AS VARCHAR[])"


def digest(seed: str, *keys: str) -> str:
    return f"md5(concat_ws('|', {q(seed)}, {', '.join(f'CAST({k} AS VARCHAR)' for k in keys)}))"


def draw(seed: str, *keys: str) -> str:
    return f"('0x' || substr({digest(seed, *keys)}, 1, 8))::BIGINT"


def choice(pool: str, seed: str, *keys: str) -> str:
    return f"({pool})[{draw(seed, *keys)} % len({pool}) + 1]"


def shuffled(pool: str, seed: str, *keys: str) -> str:
    return f"list_transform(list_sort(list_transform({pool}, lambda x, i: {{'h': {digest(seed, *keys, 'i - 1')}, 'i': i, 'x': x}})), lambda s: s.x)"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, {q(SPACES)}), lambda w: w <> '')"


def case(pairs: list[tuple[str, str]], default: str) -> str:
    return "(CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {default} END)" if pairs else default


def classify(text: str, rules: list[Rule], default: str) -> str:
    low = f"lower({text})"
    return case([(f"contains({low}, {q(r.key.lower())})" if r.kind == "part" else f"regexp_matches({low}, {q(r.pattern())})", q(r.label)) for r in rules], default)


def by_label(pools: dict[str, list[str]], label: str, default: str) -> str:
    return case([(f"{label} = {q(k)}", lst(v)) for k, v in pools.items()], lst(pools[default]))


def cues(text: str, table: list[tuple[list[str], str]]) -> str:
    return ", ".join("CASE WHEN " + " OR ".join(f"contains(lower({text}), {q(k)})" for k in keys) + f" THEN {q(label)} END" for keys, label in table)


def weighted(weights: dict[str, int], seed: str, *keys: str) -> str:
    total, out = 0, []
    for label, w in weights.items():
        total += w
        if w:
            out.append((f"{draw(seed, *keys)} % {sum(weights.values())} < {total}", q(label)))
    return case(out, "NULL")


def principle(text: str, key: str, weights: dict[str, int] | None = None, seed: str = "principle", rules: list[Rule] | None = None) -> str:
    chapter = classify(text, rules or V.CHAPTER_RULES, weighted({c: (weights or {}).get(c, 1) for c in V.CHAPTERS}, seed, key))
    return f"{chapter} || ' > ' || {choice(by_label(V.CHAPTERS, chapter, 'Chapter 1'), seed + '-part', key)}"


def layer(text: str, key: str, seed: str = "layer", rules: list[Rule] | None = None) -> str:
    return classify(text, rules or V.LAYER_RULES, choice(lst(V.LAYERS), seed, key))


def attributes(layer_: str, key: str, pools: dict | None = None) -> str:
    return f"{shuffled(by_label(pools or V.ATTRIBUTES, layer_, V.DEFAULT_LAYER), 'attributes', key)}[1:3]"


def steps(layer_: str, key: str, pools: dict | None = None, most: int = 99) -> str:
    pool = by_label(pools or V.STEPS, layer_, V.DEFAULT_LAYER)
    return f"{shuffled(pool, 'steps', key)}[1:3 + {draw('steps-count', key)} % (least(len({pool}), {most}) - 2)]"


def paraphrase(text: str, key: str, synonyms: dict[str, list[str]], seed: str = "paraphrase", strip: str = ".,?!") -> str:
    plain = f"lower(trim(w, {q(strip)}))" if strip else "lower(w)"
    one = case([(f"{plain} = {q(k)}", choice(lst(v), seed, key, "i - 1")) for k, v in synonyms.items()], "w")
    return f"array_to_string(list_transform({words(text)}, lambda w, i: {one}), ' ')"


def replaced(text: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        text = f"replace({text}, {q(a)}, {q(b)})"
    return text


def perturbation(context: str, depth: int, key: str, seed: str = "perturb") -> str:
    made = ", ".join(f"{q(a)} || {replaced(context, V.INVERSIONS) if i == 0 else context} || {q(b)}" for i, (a, b) in enumerate(V.PERTURBATION_TEMPLATES))
    return f"array_to_string({shuffled(f'[{made}]', seed, key)}[1:{depth}], ' ')"


def pairs(persona: str, context: str, prompt: str, key: str, pool: list | None = None) -> str:
    made = ", ".join(f"CASE WHEN contains({persona}, {q(need)}) THEN {{'context': {context} || {q(c)}, 'prompt': {prompt} || {q(p)}}} END" for need, c, p in pool or V.AUGMENTATIONS)
    return shuffled(f"list_filter([{made}], lambda y: y IS NOT NULL)", "pairs", key)


def shift_context(context: str, persona: str) -> str:
    return case([(f"contains(lower({persona}), {q(n)})", f"{replaced(context, [(a, b)])} || {q(' ' + s)}") for n, a, b, s, _ in V.CONTEXT_SHIFTS], context)


def adjust_prompt(prompt: str, context: str) -> str:
    return case([(f"contains({context}, {q(m)})", f"{prompt} || {q(s[4])}") for m, s in zip(V.SHIFT_MARKS, V.CONTEXT_SHIFTS)], prompt)


def json_body(text: str) -> str:
    """A JSON string's body as DuckDB writes it: beyond ASCII left as it is."""
    return f"(to_json({text})::VARCHAR)[2:-2]"


def ascii_body(text: str) -> str:
    """As ``json_body``, with characters beyond ASCII escaped (those of the basic plane)."""
    one = "CASE WHEN unicode(c) > 126 THEN '\\u' || lpad(lower(to_hex(unicode(c))), 4, '0') ELSE c END"
    return f"array_to_string(list_transform(string_split({json_body(text)}, ''), lambda c: {one}), '')"


def calculation(text: str) -> str:
    n = f"regexp_extract_all({text}, '\\d+\\.?\\d*')"
    return f"CASE WHEN len({n}) >= 2 THEN {n}[1] || ' + ' || {n}[2] WHEN len({n}) = 1 THEN {n}[1] || ' * 2' ELSE '1 + 1' END"


def arguments(tool: str, text: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """(tool, [(argument, SQL)]) for each tool."""
    first = f"{words(f'lower({text})')}[1:5]"
    joined, head = f"array_to_string({first}, ' ')", f"substr({text}, 1, 50)"
    of = {
        "calc_tool": [("query", calculation(text))],
        "python_repl": [("code", ascii_body(f"'print(' || {joined} || ')'"))],
        "read_file": [("filepath", q("/data/allowed/read/notes.txt"))],
        "write_file": [("filepath", q("/data/allowed/write/output.txt")), ("content", ascii_body(f"'Generated from: ' || {head}"))],
        "calendar_tool": [("action", q("create_event")), ("details", ascii_body(f"'Meeting about ' || coalesce(({first})[1], 'task')"))],
        "task_tracker_tool": [("task_details", ascii_body(f"'Task: ' || {head}"))],
        "get_current_weather": [("location", ascii_body(f"coalesce(({first})[-1], 'New York')"))],
    }
    return [(t, of.get(t, [("query", ascii_body(joined))])) for t in V.TOOLS]


def arguments_text(tool: str, text: str) -> str:
    """name=value of each argument, joined by semicolons."""
    return case([(f"{tool} = {q(t)}", " || ';' || ".join(f"{q(k + '=')} || {v}" for k, v in args)) for t, args in arguments(tool, text)], "''")


def call(tool: str, text: str) -> str:
    made = [(f"{tool} = {q(t)}", f"{q(V.NEED)} || '{{\"tool_call\": {{\"name\": \"{t}\", \"arguments\": {{' || " + " || ', ' || ".join(f"'\"{k}\": \"' || {json_body(f'({v})')} || '\"'" for k, v in args) + " || '}}}'") for t, args in arguments(tool, text)]
    return case(made, "NULL")


def answer(tool: str, text: str) -> str:
    made = []
    for t, args in arguments(tool, text):
        before, rest = V.TOOL_ANSWERS[t].split("{")
        arg, after = rest.split("}")
        made.append((f"{tool} = {q(t)}", f"{q(before)} || ({dict(args)[arg]}) || {q(after)}"))
    return case(made, f"'Tool result: ' || {tool} || ' executed'")


def variant_kinds(count: int, key: str) -> str:
    return shuffled(lst(kinds(count)), "variant-kinds", key)


PAIRS = """pairs AS (SELECT * FROM (SELECT conv_id, arg_min(text, turn) FILTER (WHERE role = 'user') AS prompt, arg_min(text, turn) FILTER (WHERE role = 'assistant') AS response FROM conversations GROUP BY conv_id) WHERE prompt <> '' AND response <> '')"""


def ranked(source: str, key: str, seed: str) -> str:
    return f"(SELECT *, row_number() OVER (ORDER BY {digest(seed, key)}, {key}) AS rank FROM {source})"
