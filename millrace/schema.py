"""The common schema of offers: fields, domains, null record, validity and prompt.

The tree below is the single source: the Spark type, the enum predicates, the completeness
measure and the extraction prompt are derived from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: domains of the enum fields
COMPANY_TYPES = ["startup", "scaleup", "corporation", "outsourcing agency", "software house"]
SENIORITIES = ["intern", "junior", "regular", "senior", "expert", "staff", "principal", "lead", "head", "director", "vice-president", "c-level"]
FOCUSES = ["backend", "frontend", "fullstack", "data", "embedded", "DevOps", "security", "mobile", "design", "testing", "analyst", "architect", "researcher", "management"]
SPECIALIZATIONS = ["specialized", "generalist"]
SCOPES = ["full-time", "part-time", "project"]
CONTRACTS = ["employment", "b2b/contractor", "other"]
UNITS = ["hour", "day", "week", "month", "year"]
ARCHITECTURES = ["legacy", "monolith", "microservices", "embedded", "lambda/edge"]
STAGES = ["greenfield", "mature", "legacy"]

# fixed values: fields as (name, kind or domain, meaning); kinds: text, flag, texts, and lists of allowed values
FIELDS: dict[str, list[tuple[str, object, str]] | tuple[object, str]] = {
    "employer": [("name", "text", "Employer name"), ("url", "text", "Employer website URL"), ("type", COMPANY_TYPES, "Employer company type"), ("logo", "text", "Employer logo URL")],
    "role": [
        ("title", "text", "Role title"), ("seniority", SENIORITIES, "Role seniority"), ("focus", FOCUSES, "Primary role focus"),
        ("specialization", SPECIALIZATIONS, "Role specialization profile"), ("scope", SCOPES, "Role engagement scope"),
    ],
    "workplace": [
        ("isRemote", "flag", "Whether fully remote work is allowed"), ("isHybrid", "flag", "Whether hybrid work is required or expected"), ("isOnsite", "flag", "Whether mostly onsite work is required"),
        ("travel", "flag", "Whether work-related travel is required"), ("cities", "texts", "Allowed work locations (cities)"),
    ],
    "contract": [
        ("type", ("each", CONTRACTS), "Available contract types"), ("pto", "flag", "Whether paid time off is provided (true for employment contract type)"),
        ("bankHolidays", "flag", "Whether paid bank holidays are provided (true for employment contract type)"),
    ],
    "salaryCoE": [
        ("from", "text", "Minimum compensation amount for employment (number as string)"), ("to", "text", "Maximum compensation amount for employment (number as string)"),
        ("currency", "text", "Compensation currency for employment"), ("unit", UNITS, "Compensation period unit for employment"),
    ],
    "salaryB2B": [
        ("from", "text", "Minimum compensation amount for B2B (number as string)"), ("to", "text", "Maximum compensation amount for B2B  (number as string)"),
        ("currency", "text", "Compensation currency for B2B"), ("unit", UNITS, "Compensation period unit for B2B"),
    ],
    "benefits": [("rsu", "flag", "Whether equity-based compensation is provided"), ("bonus", "flag", "Whether bonus compensation is provided"), ("multisport", "flag", "Whether sports card benefit is provided")],
    "languages": ("texts", "Required natural languages (always add English, if input is in English)"),
    "reqTechnology": ("texts", "Required programming languages, technologies and tools"),
    "optTechnology": ("texts", "Optional/nice-to-have programming languages, technologies and tools"),
    "techSkills": ("texts", "Required technical skills (without languages, technologies and tools)"),
    "softSkills": ("texts", "Required soft, people, management skills"),
    "techEnv": [
        ("aiFirst", "flag", "Whether AI-native tooling is expected in day-to-day work"), ("aiFriendly", "flag", "Whether AI tooling familiarity is a plus"),
        ("ddd", "flag", "Whether Domain-Driven Design is used or expected"), ("tdd", "flag", "Whether test first approach or TDD is expected"),
        ("architecture", ARCHITECTURES, "System architecture style (always lambda/edge when Vercel is a requirement)"), ("stage", STAGES, "System lifecycle stage"),
    ],
}
# fixed values: wording around the fields in the extraction prompt
PROMPT_HEAD = """You extract structured data from job offers.

Rules:
- If a string value cannot be confidently inferred, output null.
- For booleans: true/false if clearly stated or strongly implied; otherwise null.
- For arrays: always output an array (use [] if none).
- Prefer short, canonical tokens in lists (e.g. "TypeScript", "PostgreSQL", "AWS", "Docker"). Keep original capitalization.

Output contract:
- Return only valid JSON matching the provided schema format.
- Never hallucinate; use only information present in the input markdown.
- Apply the field-level guidance below for extraction decisions.

Field guidance:"""


def is_list(kind: object) -> bool:
    return kind == "texts" or isinstance(kind, tuple)


def leaves():
    """(path, kind, meaning) of every field in order."""
    for name, spec in FIELDS.items():
        if isinstance(spec, list):
            for leaf, kind, meaning in spec:
                yield f"{name}.{leaf}", kind, meaning
        else:
            yield name, spec[0], spec[1]


def _type(kind: object) -> T.DataType:
    return T.BooleanType() if kind == "flag" else T.ArrayType(T.StringType()) if is_list(kind) else T.StringType()


def struct_type() -> T.StructType:
    return T.StructType([
        T.StructField(n, T.StructType([T.StructField(leaf, _type(k)) for leaf, k, _ in s]) if isinstance(s, list) else _type(s[0])) for n, s in FIELDS.items()
    ])


def record(values: dict[str, Column]) -> Column:
    """A full record from columns by path. Missing paths are null, lists empty; empty texts
    and empty lists are no data, lists lose what differs in case only."""
    from .functions.text import union_ci

    def leaf(path: str, kind: object) -> Column:
        c = values.get(path)
        if is_list(kind):
            none = F.array().cast("array<string>")
            return union_ci(none, c) if c is not None else none
        if c is None:
            return F.lit(None).cast(_type(kind))
        return c.cast("boolean") if kind == "flag" else F.nullif(c, F.lit(""))

    groups = []
    for name, spec in FIELDS.items():
        if isinstance(spec, list):
            groups.append(F.struct(*[leaf(f"{name}.{x}", k).alias(x) for x, k, _ in spec]).alias(name))
        else:
            groups.append(leaf(name, spec[0]).alias(name))
    return F.struct(*groups)


def merge(target: Column, source: Column) -> Column:
    """The target record with the source's data: its values win unless they are null or
    empty, lists are united without regard to case."""
    from .functions.text import union_ci

    def leaf(path: str, kind: object) -> Column:
        a, b = target, source
        for step in path.split("."):
            a, b = a[step], b[step]
        if is_list(kind):
            return F.when(F.coalesce(F.size(b), F.lit(0)) > 0, union_ci(a, b)).otherwise(a)
        return F.coalesce(b, a) if kind == "flag" else F.coalesce(F.nullif(b, F.lit("")), a)

    groups = []
    for name, spec in FIELDS.items():
        if isinstance(spec, list):
            groups.append(F.struct(*[leaf(f"{name}.{x}", k).alias(x) for x, k, _ in spec]).alias(name))
        else:
            groups.append(leaf(name, spec[0]).alias(name))
    return F.struct(*groups)


def _at(rec: Column, path: str) -> Column:
    for step in path.split("."):
        rec = rec[step]
    return rec


def valid(rec: Column) -> Column:
    """Whether every enum field is null or in its domain."""
    tests = []
    for path, kind, _ in leaves():
        c = _at(rec, path)
        if isinstance(kind, list):
            tests.append(c.isNull() | c.isin(kind))
        elif isinstance(kind, tuple):
            tests.append(c.isNotNull() & F.forall(c, lambda x: x.isNull() | x.isin(CONTRACTS)))
        elif kind == "texts":
            tests.append(c.isNotNull())
    return reduce(lambda a, b: a & b, tests)


def quality(rec: Column) -> Column:
    """Share of nodes with data among all nodes of a record: containers, leaves and list
    elements. Groups always count as filled, empty lists, nulls and blanks do not."""
    from .functions.text import filled

    groups = sum(isinstance(s, list) for s in FIELDS.values())
    total, good = F.lit(groups), F.lit(groups)
    for path, kind, _ in leaves():
        c = _at(rec, path)
        if is_list(kind):
            total = total + 1 + F.coalesce(F.size(c), F.lit(0))
            good = good + (F.coalesce(F.size(c), F.lit(0)) > 0).cast("int") + F.coalesce(F.size(F.filter(c, lambda x: filled(x).isNotNull())), F.lit(0))
        else:
            total = total + 1
            good = good + (c.isNotNull() if kind == "flag" else filled(c).isNotNull()).cast("int")
    return good / total


def prompt() -> str:
    """The instruction for structured extraction, with guidance per field."""
    lines, group = [PROMPT_HEAD], None
    for path, kind, meaning in leaves():
        own, _, name = path.rpartition(".")
        if (own or "top-level") != group:
            group = own or "top-level"
            lines += ["", f"{group}:"]
        what = "array" if is_list(kind) else f"{'boolean' if kind == 'flag' else 'string'}, nullable"
        lines.append(f"- {name} ({what}): {meaning}")
    return "\n".join(lines)


def user_prompt(markdown: Column) -> Column:
    return F.concat(F.lit("Job offer (Markdown):\n<<<\n"), markdown, F.lit("\n>>>"))
