"""Print the physical plan tree of registered queries with their scan details:
``python -m lakeshift.plans.explain <sf_dir> name [name ...]``."""

from __future__ import annotations

import contextlib
import io
import re
import sys

from lakeshift.plans import registry
from lakeshift.session import local_session

_DETAIL = re.compile(r"^(PushedFilters|PartitionFilters|ReadSchema|Join type|Join condition|Left keys|Right keys)")


def plan_summary(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    text = out.getvalue()
    tree, _, details = text.partition("\n\n\n")
    keep, node = [], ""
    for line in details.splitlines():
        if line.startswith("("):
            node = line.strip()
        elif _DETAIL.match(line) and not line.endswith(": []"):
            keep.append(f"{node}: {line.strip()}")
    return tree.strip() + ("\n\n" + "\n".join(keep) if keep else "")


def main(argv: list[str] | None = None) -> None:
    args = list(sys.argv[1:] if argv is None else argv)
    sf_dir, names = args[0], args[1:]
    spark = local_session()
    for name in names:
        print(f"### {name}\n\n```\n{plan_summary(registry.QUERIES[name](spark, sf_dir))}\n```\n")


if __name__ == "__main__":
    main()
