"""The naive many-way plan against the same DuckDB SQL: the product of the joined
rows really has the multiplicity that the documents carry as pairs."""

from collections import Counter

import pytest

from conftest import SF0001
from docsmith import oracle
from docsmith.plans.naive import naive_document
from docsmith.sources.catalogue import Catalogue
from oracle_check import duck


@pytest.mark.parametrize("doc", ["book", "software", "game"])
def test_naive_documents(spark, doc):
    cat = Catalogue.from_adapter(spark, SF0001)
    naive = {r["id"]: r for r in naive_document(cat, doc).select(
        "id", "restrict_date", "restrict_country_code", "genre", "languages").collect()}
    sql = oracle.flat(doc, {"media_id": "id", "restrict.date[]": "dates", "genre[]": "genre",
                            "restrict.country_code[]": "countries", "languages[]": "languages"})
    rows = duck(SF0001).execute(sql).fetchall()
    assert len(rows) == len(naive)
    for i, dates, genre, countries, languages in rows:
        r = naive[i]
        assert genre == (r["genre"] and ",".join(r["genre"]))
        assert languages == (r["languages"] and ",".join(r["languages"]))
        assert countries == (r["restrict_country_code"] and ",".join(r["restrict_country_code"]))
        pairs = Counter(r["restrict_date"] or [])
        assert dates == (",".join(f"{d} x {n}" for d, n in sorted(pairs.items())) or None)
