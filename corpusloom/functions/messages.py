"""Functions over one conversation: an array of (role, content, tool_calls, tools, reasoning_content).

``tool_calls`` and ``tools`` hold JSON text, whether the source had a string or a list."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions import text as t


def _blank(c: Column) -> Column:
    return F.coalesce(t.strip(c) == "", F.lit(True))


def concat_text(conv: Column) -> Column:
    """Contents and tool calls of all messages, one part a line; null parts are left out."""
    parts = F.flatten(F.transform(conv, lambda m: F.array(m["content"], F.when(~_blank(m["tool_calls"]), m["tool_calls"]))))
    return F.array_join(F.filter(parts, lambda p: p.isNotNull()), "\n")


def is_json_list(c: Column) -> Column:
    """Whether JSON text holds a list with at least one element."""
    return F.coalesce(F.json_array_length(c) > 0, F.lit(False))


def role_letters(conv: Column) -> Column:
    """One letter a message: s, u, a, T (assistant with calls), t (tool), x."""
    letter = lambda m: (
        F.when(m["role"] == "system", "s").when(m["role"] == "user", "u")
        .when(m["role"] == "assistant", F.when(is_json_list(m["tool_calls"]), "T").otherwise("a")).when(m["role"] == "tool", "t").otherwise("x")
    )
    return F.array_join(F.transform(conv, letter), "")


def role_chain_ok(conv: Column) -> Column:
    return F.rlike(role_letters(conv), F.lit("^s?(ua|uTt+[aT])+$"))


def role_chain_reason(conv: Column) -> Column:
    """Null if the chain is in order, else the first violation.

    The longest good prefix decides: after it, what was due next and where."""
    s = role_letters(conv)
    rest_at = F.length(F.regexp_extract(s, "^s?(?:ua|uTt+[aT])*", 0))
    rest = F.substring(s, rest_at + 1, F.length(s))
    at = lambda k, word: F.concat(F.lit(f"expect_{word}_at_"), (rest_at + k).cast("string"))
    fault = (
        F.when(~rest.startswith("u"), at(0, "user"))
        .when(~rest.rlike("^u[aT]"), at(1, "assistant"))
        .when(~rest.rlike("^uTt"), "tool_calls_without_tool_messages")
        .otherwise("expect_assistant_after_tool")
    )
    return (
        F.when(F.coalesce(F.size(conv), F.lit(0)) <= 0, "empty")
        .when(s.rlike("^s(?!u)"), "after_system_expect_user")
        .when(s.rlike("^s?(ua|uTt+[aT])+$"), None)
        .otherwise(fault)
    )


def is_refusal(conv: Column, extra: Iterable[str] = ()) -> Column:
    return F.exists(conv, lambda m: (m["role"] == "assistant") & t.looks_like_refusal(m["content"], extra))


def has_think(conv: Column, markers: Iterable[str]) -> Column:
    used = [m for m in markers if m]
    if not used:
        return F.lit(False)
    hit = lambda c: F.array_contains(F.array(*[F.coalesce(F.contains(c, F.lit(k)), F.lit(False)) for k in used]), True)
    return F.exists(conv, lambda m: hit(m["content"]) | hit(m["tool_calls"]))


def replace_markers(conv: Column, markers: Mapping[str, str]) -> Column:
    return F.transform(conv, lambda m: m.withField("content", t.replace_markers(m["content"], markers)))


def repair_json(c: Column) -> Column:
    """JSON text that parses: as given without fences, without trailing commas, or with missing closing
    brackets (all ``]`` first, then all ``}``) added; null where none does."""
    s0 = t.strip_fences(c)
    s1 = t.drop_trailing_commas(s0)
    for _ in range(3):
        s1 = t.drop_trailing_commas(s1)
    lack = lambda o, k: F.greatest(F.lit(0), F.regexp_count(s1, F.lit(o)) - F.regexp_count(s1, F.lit(k)))
    s2 = F.concat(s1, F.repeat(F.lit("]"), lack(r"\[", r"\]")), F.repeat(F.lit("}"), lack(r"\{", r"\}")))
    ok = lambda s: F.try_parse_json(s).isNotNull()
    return F.when(s0 == "", None).when(ok(s0), s0).when(ok(s1), s1).when(ok(s2), s2)


def repair_tool_calls(conv: Column) -> Column:
    """Tool calls of assistants repaired; what can't be, and JSON null, is removed."""

    def one(m: Column) -> Column:
        fixed = repair_json(m["tool_calls"])
        good = F.when(fixed != "null", fixed)
        return F.when(m["role"] == "assistant", m.withField("tool_calls", good)).otherwise(m)

    return F.transform(conv, one)


def is_tool_related(conv: Column) -> Column:
    return F.exists(
        conv,
        lambda m: m["role"].isin("tool", "function") | ((m["role"] == "system") & ~_blank(m["tools"])) | ((m["role"] == "assistant") & ~_blank(m["tool_calls"]) & (F.coalesce(F.json_array_length(m["tool_calls"]), F.lit(1)) > 0)),
    )


def count_turns(conv: Column) -> Column:
    return F.size(F.filter(conv, lambda m: m["role"] == "user")).cast("long")


def is_multi_turn(conv: Column) -> Column:
    return count_turns(conv) >= 2


def tool_call_chars(conv: Column) -> Column:
    own = F.transform(F.filter(conv, lambda m: m["role"] == "assistant"), lambda m: F.coalesce(F.length(m["tool_calls"]), F.lit(0)))
    return F.aggregate(own, F.lit(0), lambda a, x: a + x).cast("long")


def conversation_key(conv: Column, algorithm: str = "sha1") -> Column:
    """Digest of the messages alone, fields in a fixed order."""
    return t.fingerprint(F.to_json(conv), algorithm)


def parsed_tools(conv: Column) -> Column:
    """JSON text of the tools that a leading system message lists; null without any, the empty string where its
    text isn't JSON, so that the row can be told."""
    first = F.get(conv, F.lit(0))
    raw = F.when(first["role"] == "system", t.strip(first["tools"]))
    return F.when(raw.isNull() | (raw == ""), None).when(F.try_parse_json(raw).isNull(), "").otherwise(raw)


def fill_tool_calls(conv: Column) -> Column:
    """Assistants' tool calls as the template takes them: JSON text stripped, what doesn't parse removed."""
    raw = lambda m: t.strip(m["tool_calls"])
    good = lambda m: F.when(F.try_parse_json(raw(m)).isNotNull(), raw(m))
    return F.transform(conv, lambda m: F.when(m["role"] == "assistant", m.withField("tool_calls", good(m))).otherwise(m))


def tool_calls_parse(conv: Column) -> Column:
    """Whether every assistant's tool calls are blank or a JSON list."""
    good = lambda m: _blank(m["tool_calls"]) | F.json_array_length(m["tool_calls"]).isNotNull()
    return F.forall(conv, lambda m: (m["role"] != "assistant") | good(m))


# chat template ---------------------------------------------------------------

BEGIN, FINISH = "<|im_start|>", "<|im_end|>\n"
# the transcript must be equal to what the published chat template prints, so its preamble is given here as it is
_TOOLS_HEAD = "# Tools\n\nYou may call one or more functions to assist with the user query.\n\nYou are provided with function signatures within <tools></tools> XML tags:\n<tools>"
_CALL = '<tool_call>\n{"name": <function-name>, "arguments": <args-json-object>}\n</tool_call>'
_TOOLS_TAIL = "\n</tools>\n\nFor each function call, return a json object with function name and arguments within <tool_call></tool_call> XML tags:\n" + _CALL
PROMPTS = (
    "You are a helpful assistant.", "You are a careful assistant that answers briefly.", "You are an assistant for general questions.",
    "Answer as clearly as you can.", "You help people with their work.",
)


def _calls(m: Column) -> Column:
    """Tool calls in their tags, ``function`` unwrapped, string arguments as they are."""
    items = F.from_json(m["tool_calls"], "array<string>")

    def one(x: Column) -> Column:
        inner = F.coalesce(F.get_json_object(x, "$.function"), x)
        name, args = F.get_json_object(inner, "$.name"), F.get_json_object(inner, "$.arguments")
        return F.concat(F.lit('<tool_call>\n{"name": "'), F.coalesce(name, F.lit("")), F.lit('", "arguments": '), F.coalesce(args, F.lit("")), F.lit("}\n</tool_call>"))

    return F.array_join(F.transform(items, one), "\n")


def _visible(m: Column) -> Column:
    """An assistant's content without what leads up to the last end of thinking."""
    c = F.coalesce(m["content"], F.lit(""))
    cut = F.when(m["reasoning_content"].isNull() & F.contains(c, F.lit("</think>")), F.regexp_replace(c, r"(?s)^.*</think>", "")).otherwise(c)
    return F.regexp_replace(cut, r"^\n+", "")


def render(conv: Column, tools: Column | None = None, generation_prompt: bool = False) -> Column:
    """The transcript of a conversation; ``tools`` is JSON text of a list, or null."""
    n = F.size(conv)

    def part(m: Column, i: Column) -> Column:
        content = F.coalesce(m["content"], F.lit(""))
        plain = F.concat(F.lit(BEGIN), m["role"], F.lit("\n"), content, F.lit(FINISH))
        seen = _visible(m)
        calls = F.when(F.coalesce(F.json_array_length(m["tool_calls"]), F.lit(0)) > 0, F.concat(F.when(seen != "", "\n").otherwise(""), _calls(m))).otherwise("")
        spoken = F.concat(F.lit(BEGIN + "assistant\n"), seen, calls, F.lit(FINISH))
        before = F.coalesce(F.get(conv, i - 1)["role"], F.lit(""))
        after = F.coalesce(F.get(conv, i + 1)["role"], F.lit(""))
        told = F.concat(
            F.when(before != "tool", BEGIN + "user").otherwise(""), F.lit("\n<tool_response>\n"), content, F.lit("\n</tool_response>"),
            F.when(after != "tool", FINISH).otherwise(""),
        )
        first_system = (m["role"] == "system") & (i == 0)
        head = F.lit("") if tools is None else F.when(tools.isNull(), "").otherwise("no")
        return (
            F.when(first_system, F.when(head == "", plain).otherwise("")).when(m["role"].isin("user", "system"), plain)
            .when(m["role"] == "assistant", spoken).when(m["role"] == "tool", told).otherwise("")
        )

    body = F.array_join(F.transform(conv, part), "")
    if tools is not None:
        first = F.get(conv, F.lit(0))
        lead = F.when(first["role"] == "system", F.concat(F.coalesce(first["content"], F.lit("")), F.lit("\n\n"))).otherwise("")
        listed = F.array_join(F.transform(F.from_json(tools, "array<string>"), lambda x: F.concat(F.lit("\n"), x)), "")
        block = F.concat(F.lit(BEGIN + "system\n"), lead, F.lit(_TOOLS_HEAD), listed, F.lit(_TOOLS_TAIL + FINISH))
        body = F.concat(F.when(tools.isNotNull(), block).otherwise(""), body)
    out = F.when(n > 0, body).otherwise("")
    return F.concat(out, F.lit(BEGIN + "assistant\n")) if generation_prompt else out


def inject_system(conv: Column, key: Column, ratio: float = 0.2, prompts: Iterable[str] = PROMPTS, seed: int = 42) -> Column:
    """A system message in front of a share of the conversations that have none, chosen by hash of the key;
    an empty system message is filled."""
    choice = F.array(*map(F.lit, prompts))
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string"))), 1, 12), 16, 10).cast("long")
    prompt = F.element_at(choice, (F.pmod(h, F.size(choice)) + 1).cast("int"))
    first = F.get(conv, F.lit(0))
    null = F.lit(None).cast("string")
    own = F.struct(F.lit("system").alias("role"), prompt.alias("content"), null.alias("tool_calls"), null.alias("tools"), null.alias("reasoning_content"))
    filled = F.concat(F.array(first.withField("content", prompt)), F.slice(conv, F.lit(2), F.greatest(F.size(conv) - 1, F.lit(0))))
    draw = (F.floor(h / 1000) % 1_000_000) < int(ratio * 1_000_000)
    return (
        F.when((first["role"] == "system") & (F.coalesce(first["content"], F.lit("")) == ""), filled)
        .when((first["role"] != "system") & draw, F.concat(F.array(own), conv)).otherwise(conv)
    )


def dpo_triplet(chosen: Column, rejected: Column) -> Column:
    """(prompt, chosen, rejected) of two conversations that part at the last reply; null where either isn't
    a conversation that ends with the assistant."""
    last = lambda c: F.get(c, F.size(c) - 1)
    good = lambda c: (F.size(c) > 0) & F.get(c, F.lit(0))["role"].isNotNull() & (last(c)["role"] == "assistant")
    return F.when(
        F.coalesce(good(chosen) & good(rejected), F.lit(False)),
        F.struct(render(_but_last(chosen)).alias("prompt"), last(chosen)["content"].alias("chosen"), last(rejected)["content"].alias("rejected")),
    )


def _but_last(c: Column) -> Column:
    return F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0)))


def same_prefix(chosen: Column, rejected: Column) -> Column:
    """Whether all messages but the last agree in role and content."""
    a, b = _but_last(chosen), _but_last(rejected)
    eq = F.zip_with(a, b, lambda x, y: x["role"].eqNullSafe(y["role"]) & x["content"].eqNullSafe(y["content"]))
    return (F.size(a) == F.size(b)) & F.forall(eq, lambda e: F.coalesce(e, F.lit(False)))


def strict_dpo_triplet(chosen: Column, rejected: Column) -> Column:
    """As ``dpo_triplet``, but a row that isn't a pair of conversations which end with the assistant and agree
    before the last reply stops the job."""
    fine = F.coalesce(dpo_triplet(chosen, rejected).isNotNull() & same_prefix(chosen, rejected), F.lit(False))
    return F.when(fine, dpo_triplet(chosen, rejected)).otherwise(F.raise_error(F.lit("not a preference pair: both sides must end with the assistant and agree before")))


def distinct_roles(conv: Column) -> Column:
    """The roles of a conversation, each once, in the order of their first turns."""
    return F.array_distinct(F.transform(conv, lambda m: m["role"]))
