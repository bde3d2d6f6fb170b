"""Absolute addresses for links found on a page."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute_url(link: Column, base_url: str) -> Column:
    """Resolve `link` against the page address `base_url`, leading `./` and `../` steps included."""
    base = urlsplit(base_url)
    host = f"{base.scheme}://{base.netloc}"
    folders = [part for part in base.path.split("/")[:-1] if part]
    steps = F.regexp_extract(link, r"^((?:\.{1,2}/)*)", 1)
    ups = F.regexp_count(steps, F.lit(r"\.\./"))
    parents = F.array(*[F.lit(part) for part in folders]).cast("array<string>")
    kept = F.slice(parents, F.lit(1), F.greatest(F.lit(len(folders)) - ups, F.lit(0)))
    folder = F.concat(F.lit("/"), F.array_join(F.transform(kept, lambda part: F.concat(part, F.lit("/"))), ""))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(F.lit(f"{base.scheme}:"), link))
        .when(link.startswith("/"), F.concat(F.lit(host), link))
        .otherwise(F.concat(F.lit(host), folder, F.regexp_replace(link, r"^(?:\.{1,2}/)+", "")))
    )
