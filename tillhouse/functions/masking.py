"""Masks for personal fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First character, rest of the local part, domain.
_EMAIL = "^(.)([^@]*)(@.*)$"


def mask_email(c: Column) -> Column:
    """`ann@x.org` to `a***@x.org`. Text without a local part and `@` stays as it is."""
    return F.regexp_replace(c, _EMAIL, "$1***$3")


def mask_phone(c: Column) -> Column:
    """Stars and the last four characters; four characters or fewer stay as they are."""
    stars = F.repeat(F.lit("*"), F.greatest(F.length(c) - 4, F.lit(0)))
    return F.concat(stars, F.right(c, F.lit(4)))


def mask_email_keep_length(c: Column) -> Column:
    """`alice@x.org` to `a***e@x.org`: length kept, a local part of two or fewer is all stars."""
    local = F.substring_index(c, "@", 1)
    size = F.length(local)
    hidden = F.when(size <= 2, F.repeat(F.lit("*"), size)).otherwise(
        F.concat(F.left(local, F.lit(1)), F.repeat(F.lit("*"), size - 2), F.right(local, F.lit(1)))
    )
    return F.when(~F.contains(c, F.lit("@")), c).otherwise(
        F.concat(hidden, F.substr(c, size + 1))
    )


def mask_phone_by_digits(c: Column) -> Column:
    """Last four characters kept when the text has at least four digits, else all stars."""
    digits = F.length(F.regexp_replace(c, "[^0-9]", ""))
    return F.when(digits < 4, F.repeat(F.lit("*"), F.length(c))).otherwise(mask_phone(c))


EMAIL_MASKS = {"first_char": mask_email, "keep_length": mask_email_keep_length}
PHONE_MASKS = {"last_four": mask_phone, "by_digits": mask_phone_by_digits}
