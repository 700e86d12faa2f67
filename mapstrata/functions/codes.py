"""Text rules for reference systems, departments and source files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the archives lie and how they are named.
ARCHIVE_HOST = "https://data.geopf.fr/telechargement/download/BDTOPO"
ARCHIVE_NAME = "BDTOPO_%s_TOUSTHEMES_GPKG_%s_%s_%s"
ARCHIVE_SUFFIX = ".7z"
CHECKSUM_SUFFIX = ".md5"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def crs_code(text: Column | str) -> Column:
    """EPSG code of a reference-system text, 0 when it names none.

    The whole text is ``EPSG:n``, or it is a definition: then the code is the
    number of the first EPSG identifier in it, an ``AUTHORITY`` or ``ID`` object
    that closes right after the number.  Case, blanks and quotes do not count.
    """
    plain = F.upper(F.regexp_replace(_col(text), r"[\s\"]", ""))
    parts = F.split(plain, r"\[EPSG,")
    named = F.transform(
        F.slice(parts, 2, F.size(parts)),
        lambda rest, i: F.when(
            F.get(parts, i).endswith("AUTHORITY") | F.get(parts, i).endswith("ID"),
            _number(F.substring_index(rest, "]", 1), rest.contains("]")),
        ),
    )
    short = _number(F.substring(plain, 6, 20), plain.startswith("EPSG:"))
    first = F.get(F.filter(named, lambda n: n.isNotNull()), F.lit(0))
    return F.coalesce(short, first, F.lit(0))


def _number(digits: Column, valid: Column) -> Column:
    return F.when(valid & digits.rlike("^[0-9]{1,9}$"), digits.cast("int"))


def department_code(code: Column | str) -> Column:
    """The code with its leading ``D``."""
    code = _col(code)
    return F.when(code.startswith("D"), code).otherwise(F.concat(F.lit("D"), code))


def department_numbers() -> Column:
    """Array of the 96 metropolitan codes: 001 to 095 without 020, 02A, 02B."""
    numbered = F.transform(
        F.array_remove(F.sequence(F.lit(1), F.lit(95)), 20),
        lambda n: F.lpad(n.cast("string"), 3, "0"),
    )
    return F.concat(numbered, F.array(F.lit("02A"), F.lit("02B")))


def requested_departments(request: Column | str) -> Column:
    """Array of codes in a request text: ``all`` or a comma-separated list."""
    request = _col(request)
    listed = F.transform(F.split(request, ","), lambda code: F.trim(code))
    return F.when(F.lower(F.trim(request)) == "all", department_numbers()).otherwise(listed)


def archive_name(version: Column, projection: Column, dept: Column, edition: Column) -> Column:
    return F.format_string(
        ARCHIVE_NAME, _col(version), _col(projection), department_code(dept), _col(edition)
    )


def archive_url(name: Column | str) -> Column:
    name = _col(name)
    return F.concat(F.lit(ARCHIVE_HOST + "/"), name, F.lit("/"), name, F.lit(ARCHIVE_SUFFIX))


def checksum_url(url: Column | str) -> Column:
    """The archive address with its ending replaced; only at the very end."""
    return F.concat(F.regexp_replace(_col(url), r"\.7z$", ""), F.lit(CHECKSUM_SUFFIX))


def expected_checksum(text: Column | str) -> Column:
    """First word of a checksum file's ``<hash>  <path>``; NULL when blank."""
    first = F.regexp_extract(_col(text), r"^\s*(\S+)", 1)
    return F.nullif(first, F.lit(""))
