"""Command line: run or check a transfer from a job properties file.

    python -m tablemover run job.properties [key=value ...]
    python -m tablemover check job.properties

``tablemover.warehouse`` (``jdbc`` or ``catalog``), ``tablemover.key.columns``
(comma-separated duplicate key), ``tablemover.column.mapping`` (comma-separated
``target=source`` pairs: all that is loaded), ``tablemover.allow.unmatched``
(``true``: columns that only one side has do not stop a load),
``tablemover.split.column`` (split reads; with the retrieve method
``split.by.range`` one or more columns of any orderable type),
``tablemover.journal`` (a shared folder in which a load keeps its phases, so
that it can be run again after a lost driver), ``tablemover.reconcile``
(``true``: prove by digests that source = target + rejects),
``tablemover.reject.addresses`` (``true``: conversion rejects tell their file,
line and values),
``tablemover.jdbc.driver`` and ``tablemover.jdbc.url``.
"""

from __future__ import annotations

import argparse
import re
import sys

from .spec import parse_option_list

# Fixed value: the driver class the reference's jobs connect with.
DEFAULT_JDBC_DRIVER = "com.teradata.jdbc.TeraDriver"


_ESCAPES = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}
_KEY_VALUE = re.compile(r"^((?:\\.|[^=:\s\\])*)\s*[=:]?\s*(.*)$", re.S)


def _unescape(text: str) -> str:
    def one(m):
        if m.group(1):  # \uXXXX
            return chr(int(m.group(1), 16))
        return _ESCAPES.get(m.group(2), m.group(2))
    return re.sub(r"\\u([0-9a-fA-F]{4})|\\(.)", one, text)


def read_properties(path: str) -> dict[str, str]:
    """A Java properties file: ``key=value``, ``key: value`` or ``key value``;
    ``#``/``!`` comments; a trailing backslash continues a line (the next
    line's leading blanks dropped); backslash escapes, ``\\uXXXX`` included."""
    props: dict[str, str] = {}
    with open(path, encoding="utf-8") as fh:
        pending = ""
        for raw in fh:
            line = pending + (raw.lstrip() if pending else raw.strip()).rstrip("\r\n")
            pending = ""
            if not line.strip() or line.lstrip()[0] in "#!":
                continue
            trailing = len(line) - len(line.rstrip("\\"))
            if trailing % 2 == 1:  # an odd number of backslashes continues the line
                pending = line[:-1]
                continue
            key, value = _KEY_VALUE.match(line.strip()).groups()
            props[_unescape(key)] = _unescape(value.strip())
    return props


def _session():
    from pyspark.sql import SparkSession
    return SparkSession.builder.appName("tablemover").getOrCreate()


def _extras(props: dict[str, str]) -> dict:
    extra = {"warehouse": props.get("tablemover.warehouse", "jdbc")}
    if extra["warehouse"] == "jdbc":
        extra["driver"] = props.get("tablemover.jdbc.driver", DEFAULT_JDBC_DRIVER)
        if props.get("tablemover.jdbc.url"):
            extra["url"] = props["tablemover.jdbc.url"]
    if props.get("tablemover.key.columns"):
        extra["key_columns"] = tuple(c.strip() for c in props["tablemover.key.columns"].split(","))
    if props.get("tablemover.column.mapping"):
        extra["column_mapping"] = parse_option_list(props["tablemover.column.mapping"])
    extra["allow_unmatched"] = props.get("tablemover.allow.unmatched", "").strip().lower() == "true"
    if props.get("tablemover.split.column"):
        extra["split_column"] = props["tablemover.split.column"]
    if props.get("tablemover.journal"):
        extra["journal"] = props["tablemover.journal"]
    extra["reconcile"] = props.get("tablemover.reconcile", "").strip().lower() == "true"
    extra["reject_addresses"] = props.get("tablemover.reject.addresses", "").strip().lower() == "true"
    return extra


def check(props: dict[str, str]) -> str:
    """Validate a properties file without Spark; an encrypted password is not
    opened, only noted as present.  Secrets print masked."""
    from .spec import CRYPTO_KEY_PATH_KEY, ENCRYPTED_CREDENTIAL_KEY, TransferSpec
    has_secret = props.get(ENCRYPTED_CREDENTIAL_KEY) and props.get(CRYPTO_KEY_PATH_KEY)
    spec = TransferSpec.from_properties(props, password="<encrypted>" if has_secret else None,
                                        **_extras(props))
    return repr(spec)


def run(props: dict[str, str]) -> str:
    from .plans.transfer import extract, load, spec_from_properties
    from .spec import Direction

    spark = _session()
    spec = spec_from_properties(spark, props, **_extras(props))
    if spec.direction == Direction.EXTRACT:
        return f"extracted to {extract(spark, spec)}"
    return str(load(spark, spec))


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="tablemover")
    sub = parser.add_subparsers(dest="command", required=True)
    p_run = sub.add_parser("run", help="run the load or extract a properties file describes")
    p_run.add_argument("properties")
    p_run.add_argument("overrides", nargs="*", help="key=value, applied after the file")
    p_chk = sub.add_parser("check", help="validate a properties file and print its spec")
    p_chk.add_argument("properties")
    args = parser.parse_args(argv)

    if args.command == "run":
        props = read_properties(args.properties)
        props.update(dict(o.split("=", 1) for o in args.overrides))
        print(run(props))
    else:
        print(check(read_properties(args.properties)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
