"""Row rules of invoice lines as Column expressions.

A rule that cannot be decided returns NULL (or a status column), so that one bad row is
data for the exception route instead of the end of the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions.keys import as_col

# The module codes of a line and those that may not carry a fee.
MODULES = ("TS", "ES", "MI")
FEE_FREE = ("ES",)
TENANT_LENGTH = 4

# The whitespace a rule ignores, and whitespace of any script.
SPACES = " \t\n\x0b\f\r"
ANY_SPACES = SPACES + "\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: str | Column, spaces: str = SPACES) -> Column:
    """Trim tabs and line ends too, where ``trim`` removes spaces only; NULL becomes blank."""
    return F.btrim(F.coalesce(as_col(c).cast("string"), F.lit("")), F.lit(spaces))


def bare(c: str | Column) -> Column:
    """Trim whitespace of any script, no-break and ideographic spaces included."""
    return strip(c, ANY_SPACES)


def worker_name(last: str | Column, first: str | Column) -> Column:
    """``Last, First``; NULL when both are blank."""
    a, b = strip(last), strip(first)
    return F.when((a == "") & (b == ""), None).otherwise(F.concat(a, F.lit(", "), b))


def line_description(last, first, week_ending, line_ref, invoice_id=None) -> Column:
    """Worker, week ending and line reference; led by the invoice id when given. A missing part leaves nothing
    that could name the line."""
    name = worker_name(last, first)
    parts = [name, as_col(week_ending).cast("string"), as_col(line_ref).cast("string")]
    if invoice_id is not None:
        parts.insert(0, as_col(invoice_id).cast("string"))
    return F.concat(parts[0], *[x for p in parts[1:] for x in (F.lit("|"), p)])


def line_type(source_type: str | Column) -> Column:
    return F.when(F.upper(strip(source_type)) == "TAX", "TAX").otherwise("ITEM")


def task_number(task_code: str | Column) -> Column:
    """What follows the first pipe, without closing parentheses; the whole code without one."""
    code = strip(task_code)
    pipe = F.instr(code, "|")
    after = F.when(pipe > 0, F.substr(code, pipe + 1)).otherwise(code)
    return F.when(code != "", strip(F.rtrim(after, F.lit(")"))))


def module_value(line_type_col: str | Column, ts: Column, es: Column, mi: Column) -> Column:
    """The value of the line's own module; an unknown module selects none."""
    module = F.upper(strip(line_type_col))
    choice = F.when(module == MODULES[0], as_col(ts))
    return choice.when(module == MODULES[1], as_col(es)).when(module == MODULES[2], as_col(mi))


def client_amount_consistent(client, supplier, margin) -> Column:
    return as_col(client) == as_col(supplier) + F.coalesce(as_col(margin), F.lit(0))


def fee_violation(line_type_col: str | Column, fee: str | Column) -> Column:
    """Why a line is refused for carrying a fee, or the empty string."""
    fee = as_col(fee)
    barred = F.upper(strip(line_type_col)).isin(*FEE_FREE) & F.coalesce(fee != 0, F.lit(False))
    return F.when(barred, F.concat(F.lit("fee of "), fee.cast("string"),
                                   F.lit(" on an expense line"))).otherwise("")


def tenant_of(invoice_number: str | Column) -> Column:
    """The buyer code that leads an invoice number; NULL when it is too short for one."""
    value = strip(invoice_number)
    return F.when(F.length(value) > TENANT_LENGTH, F.substring(value, 1, TENANT_LENGTH))


def pipe_field(text: str | Column, position: int = 4) -> Column:
    """One field of a pipe-joined text; NULL when absent or blank."""
    fields = F.split(F.coalesce(as_col(text), F.lit("")), r"\|", -1)
    return F.nullif(strip(F.get(fields, F.lit(position - 1))), F.lit(""))


def synthetic_reference(ref: str | Column, line_number: str | Column) -> Column:
    """``ref#n`` for a line its source does not number; NULL when either part is unusable."""
    value, number = strip(ref), as_col(line_number).cast("int")
    return F.when((value != "") & (number >= 1), F.concat(value, F.lit("#"), number.cast("string")))


def money(c: str | Column) -> Column:
    """Text to DECIMAL(18,2) without passing through a double; NULL when it is no amount."""
    return strip(c).try_cast("decimal(18,2)")
