"""Credential masking inside JSON text."""

from __future__ import annotations

import json
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.text import MASK

# The helpers below travel to the workers with the UDF, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A key is secret when its last word is one of these ...
SECRET_LAST_WORDS = ("password", "secret", "token", "credential", "credentials")
# ... or when its last words are one of these.
SECRET_ENDINGS = (
    "api key",
    "apikey",
    "private key",
    "ssh key",
    "secret key",
    "connection configuration",
    "connectionconfiguration",
    "db url",
    "database url",
    "connection string",
    "connectionstring",
    "jdbc url",
)
# Fixed value: keys whose text value is masked unless it is itself a JSON document.
EMBEDDED_KEYS = ("extra",)

_SECRET_KEY = re.compile(
    r"(?:^| )(?:" + "|".join(SECRET_LAST_WORDS + SECRET_ENDINGS) + r")$"
)
# Where the words of a key part.
_CAMEL_EDGE = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_WORD_GAP = re.compile(r"[_\-]+")


# Keys repeat from document to document; each worker remembers what it decided.
_DECIDED: dict[str, bool] = {}
_DECIDED_MAX = 65536


def is_secret_key(key: str) -> bool:
    """True for ``dbPassword`` or ``my-api_key``; false for ``token_url`` or ``primary_key``."""
    secret = _DECIDED.get(key)
    if secret is None:
        words = _WORD_GAP.sub(" ", _CAMEL_EDGE.sub("_", key)).strip().lower()
        secret = bool(_SECRET_KEY.search(words))
        if len(_DECIDED) < _DECIDED_MAX:
            _DECIDED[key] = secret
    return secret


def mask_fields(schema: T.DataType, value: Column) -> Column:
    """Rebuild a struct/array/map value of known schema with its secret fields masked.

    Secret fields, and fields known to embed secrets, become the mask text whatever their
    type was. Other text that is itself a JSON document is masked inside, see ``mask_embedded``.
    """
    if isinstance(schema, T.StructType):
        fields = []
        for f in schema.fields:
            inner = value.getField(f.name)
            hide = is_secret_key(f.name) or f.name.lower() in EMBEDDED_KEYS
            masked = F.lit(MASK) if hide else mask_fields(f.dataType, inner)
            fields.append(F.when(inner.isNotNull(), masked).alias(f.name))
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(schema, T.ArrayType):
        return F.transform(value, lambda x: mask_fields(schema.elementType, x))
    if isinstance(schema, T.MapType):
        if not isinstance(schema.valueType, T.StringType):
            raise TypeError("maps need string values here; use redact_json for open documents")
        return F.transform_values(
            value, lambda k, v: F.when(_secret_key_column(k), F.lit(MASK)).otherwise(mask_embedded(v))
        )
    return mask_embedded(value) if isinstance(schema, T.StringType) else value


def _secret_key_column(key: Column) -> Column:
    spaced = F.regexp_replace(key, _CAMEL_EDGE.pattern, "_")
    words = F.lower(F.trim(F.regexp_replace(spaced, _WORD_GAP.pattern, " ")))
    return F.rlike(words, F.lit(_SECRET_KEY.pattern))


def _key_pattern() -> str:
    """The rule of ``is_secret_key`` for a key as it stands in a document, before its colon."""
    gap, edge = r"(?:[_\- ]+|(?<=[a-z0-9])(?=[A-Z]))", r"(?:[_\- ]|(?<=[a-z0-9])(?=[A-Z]))"
    endings = "|".join(w.replace(" ", gap) for w in (*SECRET_LAST_WORDS, *SECRET_ENDINGS))
    return rf'"(?:(?:[^"\\\\]*{edge})?(?i:{endings})|(?i:{"|".join(EMBEDDED_KEYS)}))[_\- ]*"\s*:\s*'


def mask_embedded(text: Column) -> Column:
    """Text that is a JSON document with its secret fields masked; other text stays.

    Secret values that are no single text, number or word, and documents within such documents, can't be
    cut out by a pattern: then the whole text is masked.
    """
    key = _key_pattern()
    plain = rf'({key})(?:"(?:[^"\\\\]|\\\\.)*"|[^\s"{{}}\[\],]+)'
    cut = F.regexp_replace(text, plain, f'$1"{MASK}"')
    looks = F.rlike(text, F.lit(r"^\s*[{\[]"))
    nested = F.rlike(text, F.lit(rf"{key}[{{\[]")) | F.rlike(text, F.lit(r'\\"'))
    suspect = F.rlike(text, F.lit("(?i)" + "|".join((*SECRET_LAST_WORDS, *EMBEDDED_KEYS, "key", "configuration", "url", "string"))))
    return F.when(looks & suspect, F.when(nested, F.lit(MASK)).otherwise(cut)).otherwise(text)


def _has_unknown(schema: T.DataType, text: Column) -> Column:
    """True if JSON ``text`` holds fields that ``schema`` does not name."""
    none = F.lit(False)
    if isinstance(schema, T.StructType):
        known = F.array(*[F.lit(f.name) for f in schema.fields])
        found = F.size(F.array_except(F.json_object_keys(text), known)) > 0
        for f in schema.fields:
            if isinstance(f.dataType, (T.StructType, T.ArrayType)):
                found = F.coalesce(found, none) | _has_unknown(
                    f.dataType, F.get_json_object(text, f"$['{f.name}']")
                )
        return F.coalesce(found, none)
    if isinstance(schema, T.ArrayType) and isinstance(schema.elementType, (T.StructType, T.ArrayType)):
        parts = F.from_json(text, "array<string>")
        return F.coalesce(F.exists(parts, lambda e: _has_unknown(schema.elementType, e)), none)
    return none


def redact_json_known(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Mask a JSON text column whose schema is known, entirely inside the JVM.

    Every field of the schema is written, null if it is absent. Text that is no JSON stays as it is.
    A document with fields that the schema does not name is refused, since its secrets could not be
    told: use ``redact_json`` for open documents.
    """
    text = F.col(column)
    parsed = F.from_json(text, schema)
    masked = F.to_json(mask_fields(schema, parsed), {"ignoreNullFields": "false"})
    refused = F.raise_error(F.lit(f"{column} holds fields outside the given schema; use redact_json"))
    return df.withColumn(
        column,
        F.when(F.try_parse_json(text).isNull(), text)
        .when(_has_unknown(schema, text), refused.cast("string"))
        .otherwise(masked),
    )


_TOKEN = re.compile(
    r"[ \t\n\r]*(?:(?P<mark>[{}\[\],:])"
    r'|(?P<text>"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")'
    r"|(?P<word>-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?(?![\w.])|(?:true|false|null|NaN|-?Infinity)(?!\w)))"
)
_END = re.compile(r"[ \t\n\r]*\Z")
# Documents within documents deeper than this are masked as a whole.
_DEEPEST = 20


def _said(token: str) -> str:
    return json.loads(token) if "\\" in token else token[1:-1]


_TEXT = re.compile(r'"(?:[^"\\]|\\.)*+"')
_TEXT_OR_KEY = re.compile(r'("(?:[^"\\]|\\.)*+")([ \t\n\r]*+:[ \t\n\r]*+)?')
_BRACKET = re.compile(r'"(?:[^"\\]|\\.)*+"|([{\[])|([}\]])')
_WORD = re.compile(r"[^\s,}\]]+")


def mask_document(text: str, depth: int = 0) -> str | None:
    """The document with its secret values replaced, all else as it stood; None if it is no JSON.

    The parser tells whether it is JSON; then only its texts need a look, since nothing but a key
    stands before a colon. Documents nested too deep for the parser take ``_mask_deep``.
    """
    if text.lstrip(" \t\n\r")[:1] not in ("{", "["):
        return None
    try:
        json.loads(text, parse_int=len, parse_float=len)
    except RecursionError:
        return _mask_deep(text, depth)
    except ValueError:
        return None
    pieces, done, at, mask = [], 0, 0, json.dumps(MASK)
    look, kinds = _TEXT_OR_KEY.search, _KINDS.get
    while m := look(text, at):
        start, at = m.span()
        key = by = None
        if m[2]:
            kind = kinds(m[1])
            if kind is None:
                kind = _kind_of(m[1])
            start = at
            if kind == _SECRET:
                by, at = mask, _value_end(text, at)
            elif text[at] != '"':
                continue
            else:
                at = _TEXT.match(text, start).end()
                key = _said(m[1]) if kind == _EMBEDS else None
        else:
            kind = _OTHER
        # Only a text that may hold a document, or stands under a key known for it, needs reading.
        if by is None and (kind == _EMBEDS or text[start + 1] in _MAY_START):
            by = _masked_text(key, text[start:at], depth)
        if by is not None:
            pieces += (text[done:start], by)
            done = at
    return "".join([*pieces, text[done:]])


_OTHER, _SECRET, _EMBEDS = 0, 1, 2
_MAY_START = frozenset("{[ \\")
# Keys as they stand in documents, and what each worker decided of them.
_KINDS: dict[str, int] = {}


def _kind_of(token: str) -> int:
    key = _said(token)
    kind = _SECRET if is_secret_key(key) else _EMBEDS if key.lower() in EMBEDDED_KEYS else _OTHER
    if len(_KINDS) < _DECIDED_MAX:
        _KINDS[token] = kind
    return kind


def _value_end(text: str, start: int) -> int:
    """Where the value that starts at ``start`` ends, in valid JSON."""
    if text[start] == '"':
        return _TEXT.match(text, start).end()
    if text[start] not in "{[":
        return _WORD.match(text, start).end()
    open_ = 0
    for m in _BRACKET.finditer(text, start):
        open_ += bool(m[1]) - bool(m[2])
        if not open_:
            return m.end()
    raise ValueError("unbalanced")


def _mask_deep(text: str, depth: int = 0) -> str | None:
    """The same in one pass over all tokens with a stack of its own, so no nesting is too deep."""
    pieces, done, at = [], 0, 0
    stack: list[str] = []  # what is open: "{" or "["
    keys: list[str | None] = []  # the key that each open container stands under
    key: str | None = None
    hidden: tuple[int, int] | None = None  # (start of the hidden value, depth where it ends)
    want = "value"

    def replace(start: int, end: int, by: str) -> None:
        nonlocal done
        pieces.append(text[done:start])
        pieces.append(by)
        done = end

    mask = json.dumps(MASK)
    while want != "end":
        m = _TOKEN.match(text, at)
        if not m:
            return None
        kind, token, at = m.lastgroup, m.group(m.lastgroup), m.end()
        start = at - len(token)
        closes = kind == "mark" and token in "}]"
        if closes:
            if not stack or (stack[-1] == "{") != (token == "}") or want not in ("next", "first", "key or end"):
                return None
            if want == "key or end" and token != "}" or want == "first" and token != "]":
                return None
            stack.pop()
            key = keys.pop()
            if hidden and len(stack) == hidden[1]:
                replace(hidden[0], at, mask)
                hidden = None
        elif want in ("key", "key or end"):
            if kind != "text":
                return None
            key, want = _said(token), "colon"
            continue
        elif want == "colon":
            if token != ":":
                return None
            want = "value"
            continue
        elif want == "next":
            if token != ",":
                return None
            want = "key" if stack[-1] == "{" else "value"
            key = key if stack[-1] == "{" else None
            continue
        elif kind == "mark":
            if token not in "{[" or (not stack and at != start + 1):
                return None
            if hidden is None and key is not None and is_secret_key(key):
                hidden = (start, len(stack))
            stack.append(token)
            keys.append(key)
            key, want = None, "key or end" if token == "{" else "first"
            continue
        else:
            if not stack:
                return None
            if hidden is None:
                secret = key is not None and is_secret_key(key)
                by = mask if secret else _masked_text(key, token, depth) if kind == "text" else None
                if by is not None:
                    replace(start, at, by)
        want = "next" if stack else "end"
    if not _END.match(text, at):
        return None
    return "".join([*pieces, text[done:]])


def _masked_text(key: str | None, token: str, depth: int) -> str | None:
    """What a text value becomes, as a JSON token; None to leave it."""
    known = key is not None and key.lower() in EMBEDDED_KEYS
    said = _said(token)
    if said.lstrip()[:1] in ("{", "["):
        inner = MASK if depth >= _DEEPEST else mask_document(said, depth + 1)
        if inner is None:
            return json.dumps(MASK) if known else None
        if inner == said:
            return None
        made = json.dumps(inner, ensure_ascii=False)
        return made if made.isprintable() else json.dumps(inner)
    return json.dumps(MASK) if known and said.strip() else None


_SUSPECT = re.compile(
    "|".join((*SECRET_LAST_WORDS, *EMBEDDED_KEYS, "key", "configuration", "url", "string")),
    re.IGNORECASE,
)


def _mask_text(text: str) -> str:
    if not (_SUSPECT.search(text) or "\\u" in text):
        return text
    try:
        masked = mask_document(text)
    except Exception:  # one hostile document must not end the job, nor be shown
        return MASK
    return text if masked is None else masked


@F.pandas_udf(T.StringType())
def redact_json(documents: pd.Series) -> pd.Series:
    """Mask JSON text of open schema, at any depth; only this column travels to Python.

    Only masked values change; all other text stays as it stood. Text that is no JSON object or
    array stays as it is. Documents without any word that could make a key secret skip the parser.
    """
    return documents.map(_mask_text, na_action="ignore")
