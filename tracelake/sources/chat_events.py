"""Event classifier of transcript blocks: one ordered CASE expression, the first match wins.

The expression is written as SQL text, so it reaches Spark in one call; it is
evaluated row by row inside the JVM and stops at the first rule that holds.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tracelake.functions.text import LINE_END, SPACE as S, SPACES

# Slash command to kind of event; other commands are "command".
COMMAND_KINDS = {
    "/add": "context_file",
    "/read-only": "context_file",
    "/drop": "context_file",
    "/run": "shell",
    "/test": "test",
    "/lint": "lint",
    "/git": "git",
    "/map": "repo_map",
    "/tokens": "usage",
    "/clear": "history",
    "/reset": "history",
    "/save": "history",
    "/load": "history",
    "/ask": "mode",
    "/code": "mode",
    "/architect": "mode",
    "/chat-mode": "mode",
    "/copy-context": "context_dump",
    "/web": "web",
    "/commit": "git",
    "/undo": "git",
    "/diff": "git",
    "/settings": "settings",
}
OTHER_COMMAND = "command"

# Texts a tool line is recognised by. S is Python's white space class.
TOKENS = rf"Tokens:{S}+([0-9.]+[kM]?){S}+sent,{S}+([0-9.]+[kM]?){S}+received\."
COMMIT = rf"(?d)^(?:Commit|> Commit){S}+([0-9a-f]+){S}+(.+?){S}*$"
UNDO = rf"(?d)^(?:Removed:|> Removed:){S}+([0-9a-f]+){S}+(.+?){S}*$"
NO_EDIT = rf"(?d)Did not apply edit to (.+?){S}+\(--dry-run\)"
EDIT = rf"(?d)Applied edit to (.+?){S}*$"
SAVED = rf"(?d)Saved commands to (.+?){S}*$"
EXECUTED = rf"(?d)Executing: (/.+?){S}*$"
OUTPUT_ADDED = r"Added (\p{Nd}+) lines? of output to the chat\."
FILE_PROMPT = rf"(?d)(?:Create new file|Add file to the chat)\? .*?: ([a-z]){S}*$"
ADDED = r"(?d)Added (.+?) to the chat"
READ_ONLY = r"(?d)Added (.+?) to read-only files\.|(.+?) \(read only\)"
DROPPED = r"(?d)(?:Dropped|Removed) (.+?) from the chat"
MODE = rf"(?d)Model:{S}+(.+?){S}+with{S}+(.+?){S}+edit format"
GIT_STATUS = rf"^[?MADRCU!]{{1,2}}{S}+|^[0-9a-f]{{7,}}{S}+"
CLEARED = ["All chat history cleared", "All files dropped and chat history cleared"]
RESTORED = ["Restored previous conversation history"]
COPIED = ["Copied code context to clipboard"]
LINT = ["No dirty files to lint", "flake8"]
FAILED = ["FAILED ", "FAILURES", "AssertionError"]
REPO_SUMMARY = ["Here are summaries of some files present in my git repository"]
WEB = ["Scraping http", "Install playwright", "Playwright"]
TOKEN_REPORT = ["tokens remaining", "tokens total"]
# Launch option flags and the texts that set them.
LAUNCH_FLAGS = {
    "message_mode": ["--message ", "--message="],
    "message_file": ["--message-file ", "--message-file="],
    "dry_run": ["--dry-run"],
    "restore_history": ["--restore-chat-history"],
    "no_git": ["--no-git"],
    "show_repo_map": ["--show-repo-map"],
}

EMPTY = "cast(map() as map<string, string>)"


def _str(text: str) -> str:
    """A raw SQL string literal."""
    return "r'" + text + "'"


def _any(text: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {_str(n)})" for n in needles) + ")"


def _starts(text: str, *heads: str) -> str:
    return "(" + " OR ".join(f"startswith({text}, {_str(h)})" for h in heads) + ")"


def _matches(text: str, pattern: str) -> str:
    return f"regexp_like({text}, {_str(pattern)})"


def _group(text: str, pattern: str, n: int) -> str:
    return f"if({_matches(text, pattern)}, regexp_extract({text}, {_str(pattern)}, {n}), null)"


def _strip(text: str) -> str:
    return f"btrim({text}, {_str(SPACES)})"


def _let(name: str, value: str, inner: str) -> str:
    """SQL has no names inside an expression; here `inner` uses a value by name, which is thus computed once."""
    return f"transform(array({value}), {name} -> {inner})[0]"


def _first_word(text: str) -> str:
    return f"regexp_extract({text}, {_str(rf'\A{S}*([^{S[1:]}+)')}, 1)"


def _json(text: str) -> str:
    """JSON text of a string; null stays null, so the field is left out."""
    inner = f"regexp_extract(to_json(named_struct('v', {text})), {_str('(?s)^.{5}(.*).$')}, 1)"
    return f"if({text} is null, null, {inner})"


def _fields(values: dict[str, str]) -> str:
    """Map of field name to JSON text without the null ones."""
    pairs = ", ".join(f"'{name}', {v}" for name, v in values.items())
    return f"map_filter(map({pairs}), (k, v) -> v is not null)"


def _after_colon(text: str) -> str:
    return _strip(f"regexp_extract({text}, {_str(r'(?s)^[^:]*:(.*)$')}, 1)")


def _command_kind(name: str) -> str:
    known = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COMMAND_KINDS.items())
    return f"CASE {name} {known} ELSE '{OTHER_COMMAND}' END"


def _user_fields(text: str) -> str:
    command = f"if({_starts('body', '/')}, regexp_extract(body, {_str(rf'\A([^{LINE_END[1:]}*)')}, 1), null)"
    fields = _fields({
        "command": f"coalesce({_json('command')}, 'null')",
        "command_name": _json("name"),
        "command_kind": f"if(name is null, null, {_json(_command_kind('name'))})",
    })
    return _let("body", _strip(text), _let("command", command, _let("name", _first_word("command"), fields)))


def _rules(text: str) -> list[tuple[str, str, dict[str, str]]]:
    """(test, kind, extra event fields) in order, for the content of one tool line."""
    word = _first_word(text)
    launch = (
        f"(({_starts(word, '/')} AND endswith({word}, '/aider')) OR {word} = 'aider'"
        f" OR ({_any(text, ['aider '])} AND {_any(text, ['--'])}))"
    )
    flags = {k: f"if({_any(text, v)}, 'true', 'false')" for k, v in LAUNCH_FLAGS.items()}

    def found(pattern: str, kind: str, **groups: int):
        return _matches(text, pattern), f"'{kind}'", {k: _json(_group(text, pattern, n)) for k, n in groups.items()}

    def has(needles: list[str], kind: str, also: str = "false"):
        return f"({_any(text, needles)} OR {also})", f"'{kind}'", {}

    either = f"coalesce(nullif({_group(text, READ_ONLY, 1)}, ''), nullif({_group(text, READ_ONLY, 2)}, ''), '')"
    return [
        (launch, "'startup'", {"command": _json(text), **flags}),
        (_starts(text, "Aider v"), "'startup'", {"version": _json(_strip(f"substring({text}, 8)"))}),
        (
            _starts(text, "Model:", "Main model:"), "'startup'",
            {
                "model": _json(_after_colon(text)), "model_name": _json(_group(text, MODE, 1)),
                "edit_format": _json(_group(text, MODE, 2)),
            },
        ),
        (_starts(text, "Git repo:"), "'startup'", {"git_repo": _json(_after_colon(text))}),
        (_starts(text, "Repo-map:"), "'repo_map'", {"repo_map": _json(_after_colon(text))}),
        (_starts(text, "/"), _command_kind(word), {"command": _json(text), "command_name": _json(word)}),
        found(TOKENS, "usage", sent=1, received=2),
        found(COMMIT, "git_commit", hash=1, message=2),
        found(UNDO, "git_undo", hash=1, message=2),
        found(NO_EDIT, "dry_run", path=1),
        found(EDIT, "edit_applied", path=1),
        found(SAVED, "history_save", path=1),
        found(EXECUTED, "history_load_exec", command=1),
        has(CLEARED, "history_clear"),
        has(RESTORED, "history_restore"),
        has(COPIED, "context_dump"),
        has(LINT, "lint", f"contains(lower({text}), 'lint')"),
        has(FAILED, "test_failure"),
        found(OUTPUT_ADDED, "shell_output_added", lines=1),
        has(REPO_SUMMARY, "repo_map"),
        has(WEB, "web"),
        found(FILE_PROMPT, "confirmation", answer=1),
        found(ADDED, "context_file", path=1),
        (_matches(text, READ_ONLY), "'context_file'", {"path": _json(_strip(either))}),
        found(DROPPED, "context_file", path=1),
        (f"({_starts(text, '$ ')} OR {_any(text, TOKEN_REPORT)})", "'usage'", {}),
        (_matches(text, GIT_STATUS), "'git'", {}),
    ]


def classify(role: str, content: str) -> Column:
    """struct(kind, event) of two columns; event maps field names to JSON text. Tool content is one line."""
    raw = {"raw": _json(content)}

    def event(kind: str, fields: str) -> str:
        return f"named_struct('kind', {kind}, 'event', {fields})"

    cases = [
        f"WHEN {role} = 'system' THEN {event("'session_start'", EMPTY)}",
        # Most prompts carry no command; one anchored look settles those.
        f"WHEN {role} = 'user' AND NOT {_matches(content, rf'\A{S}*/')}"
        f" THEN {event("'user_prompt'", "map('command', 'null')")}",
        f"WHEN {role} = 'user' THEN {event("'user_prompt'", _user_fields(content))}",
        f"WHEN {role} <> 'tool' THEN {event('cast(null as string)', EMPTY)}",
    ]
    for test, kind, extra in _rules(content):
        cases.append(f"WHEN {test} THEN {event(kind, _fields({**raw, **extra}))}")
    return F.expr(f"CASE {' '.join(cases)} ELSE {event("'raw_status'", _fields(raw))} END")
