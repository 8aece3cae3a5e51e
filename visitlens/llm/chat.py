"""Chat formatting by schema fingerprint, in DataFrame operations only.

Records come in layouts: a prompt with a response, an instruction with input and output, a
list of messages under various names, or rows by turn. The nested field paths of a record
are hashed, and the hashes select a declarative mapping that yields canonical turns, an array
of (role, text): the mapping with the most paths of those whose paths the record has all. Paths that no
mapping asks for are left alone. A column of structs has one set of paths; a column of JSON texts has one per
row, of all items of its lists, so layouts may be mixed. A list without items selects the
mapping of its name and gives no turns. Records of an unknown layout, and texts that are no
JSON objects, are kept with null turns.

``formatted`` writes turns as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts
``<`` and ``|`` are parted by one more backslash than they had between them, so no text can
hold a control string and the step is reversible; roles also escape line ends. ``read_back``
parses the output. The loss mask gives each turn's lengths and whether its text is learned.

Null texts count as empty texts, null roles as empty roles; a null array gives a null
conversation, an empty one an empty output. Rows of one turn number are ordered by role and
text; repeated rows are turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"

TURNS = "array<struct<role: string, text: string>>"

# Role names of other layouts and their canonical names.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def paths(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a type; ``[]`` stands for the items of an array."""
    if isinstance(kind, T.StructType):
        return [p for field in kind for p in paths(field.dataType, f"{at}.{field.name}" if at else field.name)]
    if isinstance(kind, T.ArrayType):
        return paths(kind.elementType, f"{at}[]")
    return [at]


def _hashed(names: list[str]) -> str:
    """SQL for the hashes of field paths, in any case."""
    listed = ", ".join("xxhash64('" + name.lower().replace("'", "\\'") + "')" for name in names)
    return f"array({listed})"


def _messages(items: str, role: str, text: str) -> str:
    return f"transform({items}, m -> struct(m.{role} as role, m.{text} as text))"


def _pair(first: str, second: str, system: str | None = None) -> str:
    """The turns of a question and its answer, after a system text if there is one."""
    turns = f"array(struct('user' as role, {first} as text), struct('assistant' as role, {second} as text))"
    if system is None:
        return turns
    head = f"struct('system' as role, {system} as text)"
    return f"if(coalesce({system}, '') = '', {turns}, concat(array({head}), {turns}))"


_JOINED = "if(coalesce(r.input, '') = '', r.instruction, concat(coalesce(r.instruction, ''), '\\n\\n', r.input))"

#: Layouts: the type of a record and SQL for its turns, with the record as ``r``.
LAYOUTS: dict[str, tuple[str, str]] = {
    "prompt_response": ("prompt string, response string", _pair("r.prompt", "r.response")),
    "prompt_completion": ("prompt string, completion string", _pair("r.prompt", "r.completion")),
    "system_prompt_response": (
        "system string, prompt string, response string",
        _pair("r.prompt", "r.response", "r.system"),
    ),
    "question_answer": ("question string, answer string", _pair("r.question", "r.answer")),
    "instruction_output": ("instruction string, output string", _pair("r.instruction", "r.output")),
    "instruction_input_output": ("instruction string, input string, output string", _pair(_JOINED, "r.output")),
    "messages": (
        "messages array<struct<role: string, content: string>>",
        _messages("r.messages", "role", "content"),
    ),
    "conversations": (
        "conversations array<struct<from: string, value: string>>",
        _messages("r.conversations", "`from`", "value"),
    ),
    "turns": ("turns array<struct<role: string, text: string>>", _messages("r.turns", "role", "text")),
    "rows_by_turn": (
        "turns array<struct<turn: bigint, role: string, text: string>>",
        "array_sort(transform(r.turns, t -> struct(t.turn as turn, t.role as role, t.text as text)))",
    ),
}


def _paths_of(layout: str) -> list[str]:
    return paths(T._parse_datatype_string(LAYOUTS[layout][0]))


def _canonical(layout: str) -> str:
    """A layout's turns with known role names and without nulls; rows by turn have theirs already."""
    turns = LAYOUTS[layout][1]
    if layout == "rows_by_turn":
        return f"transform({turns}, t -> struct(coalesce(t.role, '') as role, coalesce(t.text, '') as text))"
    names = " ".join(f"when '{old}' then '{new}'" for old, new in ROLES.items())
    role = f"case lower(t.role) {names} else coalesce(t.role, '') end"
    return f"transform({turns}, t -> struct({role} as role, coalesce(t.text, '') as text))"


def _chosen(hashes: str) -> str:
    """SQL for the name of the layout that hashes of paths select."""
    by_size = sorted(LAYOUTS, key=lambda name: -len(_paths_of(name)))
    whole = " ".join(f"when size(array_except({_hashed(_paths_of(name))}, {hashes})) = 0 then '{name}'" for name in by_size)
    lists = [name for name in by_size if "[]" in _paths_of(name)[0]]
    empty = " ".join(
        f"when array_contains({hashes}, xxhash64('{_paths_of(name)[0].split('.')[0]}')) then '{name}'" for name in lists
    )
    return f"case {whole} {empty} end"


def from_structs(df: DataFrame, record: str = "record") -> DataFrame:
    """Adds ``layout`` and ``turns`` by the layout of the struct column ``record``, which has one type."""
    hashes = _hashed(paths(df.schema[record].dataType))
    layout = df.sparkSession.range(1).selectExpr(f"{_chosen(hashes)} as name").first().name
    if layout is None:
        return df.withColumn("layout", F.lit(None).cast("string")).withColumn("turns", F.lit(None).cast(TURNS))
    return (
        df.withColumn("layout", F.lit(layout))
        .withColumn("_r", F.array(F.col(record)))
        .withColumn("turns", F.expr(f"transform(_r, r -> {_canonical(layout)})[0]").cast(TURNS))
        .drop("_r")
    )


def _kind(value: str, kind: str) -> str:
    return f"coalesce(startswith(schema_of_variant({value}), '{kind}'), false)"


_ITEM_PATHS = (
    f"if({_kind('i', 'OBJECT')}, transform(map_keys(cast(i as map<string, variant>)), x -> concat(e.key, '[].', x)), "
    "array(concat(e.key, '[].')))"
)
_LIST_PATHS = (
    "if(size(cast(e.value as array<variant>)) = 0, array(concat(e.key, '[]')), "
    f"flatten(transform(cast(e.value as array<variant>), i -> {_ITEM_PATHS})))"
)
#: Field paths of a JSON object: its keys, and those of all items of a list under a key.
_JSON_PATHS = (
    f"array_distinct(flatten(transform(map_entries(cast(_json as map<string, variant>)), "
    f"e -> if({_kind('e.value', 'ARRAY')}, {_LIST_PATHS}, array(e.key)))))"
)


def from_json_texts(df: DataFrame, record: str = "record") -> DataFrame:
    """Adds ``layout`` and ``turns`` by the layout of each row's JSON text."""
    parsed = df.withColumn("_json", F.expr(f"try_parse_json(`{record}`)"))
    hashed = F.expr(f"case when {_kind('_json', 'OBJECT')} then transform({_JSON_PATHS}, p -> xxhash64(lower(p))) end")
    named = parsed.withColumn("_print", hashed).withColumn("layout", F.expr(f"if(_print is null, null, {_chosen('_print')})"))
    turns = F.lit(None).cast(TURNS)
    for name, (kind, _) in LAYOUTS.items():
        own = f"transform(array(from_json(`{record}`, '{kind}')), r -> {_canonical(name)})[0]"
        turns = F.when(F.col("layout") == name, F.expr(own)).otherwise(turns)
    return named.withColumn("turns", turns.cast(TURNS)).drop("_print", "_json")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_out(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def formatted(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Adds ``formatted`` and ``loss_mask``: for each turn the characters of its head and of
    its body, and whether the body is learned. Heads and ends of turns never are."""
    pieces = F.transform(
        F.col(turns),
        lambda t: F.struct(
            F.concat(F.lit(START), _role_out(t["role"]), F.lit("\n")).alias("head"),
            escaped(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("learned"),
        ),
    )
    written = F.transform("_pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END + "\n")))
    mask = F.transform(
        "_pieces",
        lambda p: F.struct(F.length(p["head"]).alias("head"), F.length(p["body"]).alias("body"), p["learned"].alias("learned")),
    )
    return (
        df.withColumn("_pieces", pieces)
        .withColumn("formatted", F.array_join(written, ""))
        .withColumn("loss_mask", mask)
        .drop("_pieces")
    )


def read_back(df: DataFrame) -> DataFrame:
    """Adds ``read_turns``, the turns parsed from ``formatted``, and ``loss_texts``, the texts
    under ``loss_mask``, both unescaped."""
    end = END.replace("|", "\\|") + "\n"
    whole = F.split("formatted", end)
    turns = F.when(F.col("formatted") == "", F.array().cast("array<string>")).otherwise(
        F.slice(whole, F.lit(1), F.size(whole) - 1)
    )
    read = F.transform(
        "_written",
        lambda p: F.struct(
            _role_in(F.substring(F.substring_index(p, "\n", 1), len(START) + 1, F.length(p))).alias("role"),
            unescaped(F.substring(p, F.length(F.substring_index(p, "\n", 1)) + 2, F.length(p))).alias("text"),
        ),
    )
    learned = F.filter(F.arrays_zip("_written", "loss_mask"), lambda x: x["loss_mask"]["learned"])
    texts = F.transform(
        learned,
        lambda x: unescaped(F.substring(x["_written"], x["loss_mask"]["head"] + 1, x["loss_mask"]["body"])),
    )
    return (
        df.withColumn("_written", turns)
        .withColumn("read_turns", read)
        .withColumn("loss_texts", texts)
        .drop("_written")
    )


def conversations(rows: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) as one record per conversation."""
    turn = F.struct(F.col("turn").cast("long").alias("turn"), "role", "text")
    return rows.groupBy("conv_id").agg(F.struct(F.collect_list(turn).alias("turns")).alias("record"))


def formatted_conversations(rows: DataFrame) -> DataFrame:
    """Conversations in rows by turn, formatted: conv_id, turns, formatted, loss_mask."""
    return formatted(from_structs(conversations(rows))).drop("record", "layout")
