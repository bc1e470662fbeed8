import json

import pytest

from ledgerfold.sources import crossref, datacite, github, observation, osti, task_pages, wdh, zenodo  # noqa: F401
from ledgerfold.sources.observation import MAPPERS, map_source, register_mapper

TASKS = {f"task-{n}": f"task-{n}" for n in range(25, 60)} | {"task-19": "task-54", "task-34": "task-59"}
MENTION = r"(?i)wind(?:\s+tcp)?\s+task\s+(\d{1,3})(?:\s*/\s*(\d{1,3}))?"


def raw(spark, *payloads, ids=None, **cols):
    rows = [(ids[i] if ids else str(i), p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "source_id string, payload string")
    from pyspark.sql import functions as F

    for k, v in cols.items():
        df = df.withColumn(k, F.lit(v))
    return df


def mapped(df):
    rows = df[0].collect() if isinstance(df, tuple) else df.collect()
    return [(r, json.loads(r["source"])) for r in rows]


def test_zenodo_prefers_the_concept_and_keeps_the_version(spark):
    payload = {
        "id": 12, "revision": 3, "doi": "10.5072/ZENODO.12", "conceptdoi": "10.5072/zenodo.11",
        "links": {"self_html": "https://zenodo.org/records/12"},
        "files": [{"key": "a b.CSV"}, {"key": "x/y", "type": "ZIP"}],
        "metadata": {
            "title": "Lidar", "description": "<p>Hi<script>x</script></p>", "creators": [{"name": "Müller, S."}, {}],
            "license": {"id": "cc-by-4.0"}, "access_right": "open", "publication_date": "2024",
            "resource_type": {"type": "publication", "subtype": "deliverable"},
            "communities": [{"id": "wakes"}, {"id": "windtask_034"}, {"id": "windtask777"}],
            "related_identifiers": [{"relation": "cites", "identifier": "10.5072/z", "scheme": "doi"}, {"relation": "x"}],
            "keywords": ["a"],
        },
    }
    ((row, s),) = mapped(map_source("zenodo", raw(spark, payload), declared={"wakes": ["Task 31"]},
                                    tasks=TASKS, community_pattern="windtask"))
    assert row["identity_key"] == "10.5072/zenodo.11" and row["source_key"] == "3@10.5072/zenodo.12~m3"
    assert s["notes"] == "<p>Hi</p>" and s["license_id"] == "cc-by" and s["license_raw"] == "cc-by-4.0"
    assert s["resource_kind"] == "report" and s["access_status"] == "open" and s["published_date"] == "2024"
    assert s["resources"] == [
        {"url": "https://zenodo.org/records/12/files/a%20b.CSV", "name": "a b.CSV", "format": "csv"},
        {"url": "https://zenodo.org/records/12/files/x/y", "name": "x/y", "format": "zip"}]
    assert s["task"] == ["task-31", "task-59"] and s["withdrawn"] is False
    assert s["related_identifiers"][0] == {"relation": "IsVersionOf", "identifier": "10.5072/zenodo.11", "identifier_type": "DOI"}
    assert s["related_identifiers"][1]["identifier_type"] == "DOI" and len(s["related_identifiers"]) == 2
    assert s["extra"]["zenodo_record_id"] == 12 and s["extra"]["zenodo_resource_type"]["subtype"] == "deliverable"
    assert {k: v["extraction_method"] for k, v in row["provenance"].items()}["task"] == "pattern"


def test_zenodo_tombstone_and_unstated_access(spark):
    out = mapped(map_source("zenodo", raw(spark, {"id": 1, "tombstone": {"note": "x"}}, {"id": 2, "metadata": {}})))
    by = {r["source_id"]: s for r, s in out}
    assert by["0"]["withdrawn"] is True and by["0"]["access_status"] == "metadata-only"
    assert by["1"]["access_status"] == "unknown" and by["1"]["license_id"] == "notspecified" and "resource_kind" not in by["1"]


def test_datacite_titles_dates_rights_and_candidates(spark):
    payload = {"id": "10.5072/ABC", "attributes": {
        "doi": "10.5072/ABC", "state": "findable", "updated": "2026-08-30T09:55:55.000Z", "url": "https://x.org/1",
        "titles": [{"title": "Sub", "titleType": "Subtitle"}, {"title": "Main"}],
        "creators": [{"givenName": "A", "familyName": "B", "affiliation": [{"name": "DTU"}],
                      "nameIdentifiers": [{"nameIdentifierScheme": "ORCID", "nameIdentifier": "https://orcid.org/0000-1"}]}],
        "publisher": {"name": "Pub"}, "dates": [{"dateType": "Issued", "date": "2020"}, {"dateType": "Issued", "date": "2020-05-01"}],
        "publicationYear": 2019, "types": {"resourceTypeGeneral": "Other", "resourceType": "Technical Report"},
        "rightsList": [{"rights": "mystery"}, {"rights": "info:eu-repo/semantics/openAccess"}, {"rightsIdentifier": "cc-by-4.0"}],
        "subjects": [{"subject": "a"}, {"subject": "a"}, {"subject": "Wind Task 25/63"}],
        "relatedIdentifiers": [{"relatedIdentifier": "10.5072/Q", "relatedIdentifierType": "DOI", "relationType": "IsVersionOf"}],
        "descriptions": [{"description": "meth", "descriptionType": "Methods"}, {"description": "<b>abs</b>", "descriptionType": "Abstract"}],
        "isActive": False}}
    ((row, s),) = mapped(map_source("datacite", raw(spark, payload, ids=["10.5072/ABC"]), task_pattern=MENTION))
    assert row["identity_key"] == "10.5072/abc" == row["source_id"] and row["source_key"] == "2026-08-30T09:55:55Z~m2"
    assert s["title"] == "Main" and s["notes"] == "<b>abs</b>" and s["published_date"] == "2020-05-01"
    assert s["license_raw"] == "cc-by-4.0" and s["license_id"] == "cc-by" and s["access_status"] == "open"
    assert s["resource_kind"] == "report" and row["provenance"]["resource_kind"]["extraction_method"] == "pattern"
    assert s["withdrawn"] is True and s["authors"] == [{"name": "B, A", "given": "A", "family": "B", "orcid": "0000-1", "affiliation": "DTU"}]
    assert s["keywords"] == ["a", "Wind Task 25/63"] and s["extra"]["task_candidates"] == ["task-25", "task-63"]
    assert s["extra"]["alternate_titles"] == [{"title": "Sub", "title_type": "Subtitle"}]
    assert s["extra"]["other_descriptions"] == [{"description": "meth", "description_type": "Methods"}]
    assert s["related_identifiers"] == [{"identifier": "10.5072/q", "identifier_type": "DOI", "relation": "IsVersionOf"}]


def test_crossref_preprint_takes_the_published_identity(spark):
    pre = {"DOI": "10.5072/PRE", "type": "posted-content", "title": ["A  <i>b</i>"], "URL": "https://doi.org/10.5072/pre",
           "relation": {"is-preprint-of": [{"id-type": "doi", "id": "10.5072/PUB"}], "has-review": [{"id-type": "url", "id": "u"}]},
           "issued": {"date-parts": [[2016, 9]]}, "deposited": {"date-time": "2020-01-01T00:00:00Z"},
           "author": [{"family": "B", "given": "A", "ORCID": "http://orcid.org/0000-2"}, {"name": "Org"}, {}],
           "license": [{"URL": "https://creativecommons.org/licenses/by/4.0/", "content-version": "tdm"},
                       {"URL": "https://x.org/closed", "content-version": "vor"}],
           "reference": [{"DOI": "10.5072/R1"}, {"key": "x"}, {"DOI": "10.5072/r1"}], "subject": ["S &amp; T", ""],
           "abstract": "<jats:p>Hello</jats:p>"}
    ret = {"DOI": "10.5072/ret", "type": "journal-article", "title": ["T"], "URL": "https://doi.org/10.5072/ret",
           "updated-by": [{"type": "retraction", "DOI": "10.5072/RET"}], "update-to": [{"type": "erratum", "DOI": "10.5072/o"}]}
    out = {r["source_id"]: (r, s) for r, s in mapped(map_source("crossref", raw(spark, pre, ret, ids=["10.5072/PRE", "10.5072/ret"])))}
    row, s = out["10.5072/PRE"]
    assert row["identity_key"] == "10.5072/pub" and row["source_key"] == "2020-01-01T00:00:00Z~m2"
    assert s["url"] == "https://doi.org/10.5072/pub" and s["source_urls"] == ["https://doi.org/10.5072/pub", "https://doi.org/10.5072/pre"]
    assert s["title"] == "A b" and s["extra"]["crossref_title_raw"] == "A  <i>b</i>" and s["extra"]["crossref_title_html"] == "A <i>b</i>"
    assert s["published_date"] == "2016-09" and s["notes"] == "<p>Hello</p>"
    assert s["authors"] == [{"name": "B, A", "given": "A", "family": "B", "orcid": "0000-2"}, {"name": "Org"}]
    assert s["license_raw"] == "https://x.org/closed" and s["license_id"] == "notspecified"
    assert s["extra"]["crossref_references"] == ["10.5072/r1"] and s["extra"]["crossref_preprint_doi"] == "10.5072/pre"
    assert {(x["relation"], x["identifier"]) for x in s["related_identifiers"]} == {("HasReview", "u"), ("IsPreprintOf", "10.5072/pub")}
    assert s["keywords"] == ["S & T"] and s["withdrawn"] is False
    row, s = out["10.5072/ret"]
    assert s["withdrawn"] is True and s["extra"]["crossref_retraction"]["type"] == "retraction"
    assert s["related_identifiers"] == [{"relation": "IsErratumOf", "identifier": "10.5072/o", "identifier_type": "DOI"}]


def test_github_release_archive_and_badge(spark):
    payload = {"repository": {"id": 7, "full_name": "o/r", "html_url": "https://github.com/o/r", "description": " d ",
                              "topics": ["b", "a"], "license": {"spdx_id": "MIT"}, "archived": True, "private": False,
                              "created_at": "2020-01-02T00:00:00Z", "owner": {"login": "o"}, "size": 5},
               "latest_release": {"tag_name": "v1", "html_url": "https://github.com/o/r/v1", "published_at": "2025-06-16T19:37:46Z"},
               "head_ref": {"object": {"sha": "abc"}}, "_resolved": {"doi": "10.5072/Z", "version_doi": "10.5072/z1", "task": ["task-37"]}}
    bare = {"repository": {"full_name": "o/s", "description": "", "license": None}}
    out = {r["source_id"]: (r, s) for r, s in mapped(map_source("github", raw(spark, payload, bare, ids=["o/r", "o/s"])))}
    row, s = out["o/r"]
    assert row["identity_key"] == "10.5072/z" and row["source_key"].startswith("abc:v1:")
    assert s["archived"] is True and s["license_id"] == "mit" and s["published_date"] == "2025-06-16" and s["version"] == "v1"
    assert [r["format"] for r in s["resources"]] == ["git", "release"] and s["task"] == ["task-37"]
    assert s["related_identifiers"][0]["identifier"] == "10.5072/z1" and s["extra"]["github_repo_id"] == 7
    row, s = out["o/s"]
    assert row["identity_key"] == "github|o/s" and "notes" not in s and "license_raw" not in s and s["access_status"] == "unknown"


def test_osti_packed_authors_subjects_and_deposits(spark):
    payload = {"osti_id": "99", "doi": "https://doi.org/10.5072/pub", "title": "Group: Wind Task 19 and Wind Task 34",
               "authors": ["Hall, Matthew [NREL, Golden, CO] (ORCID:0000000203988320)", " "],
               "subjects": ["ENGINEERING,WIND ENERGY", "29 ENERGY PLANNING, POLICY, AND ECONOMY"],
               "publication_date": "2021-01-01T00:00:00Z", "product_type": "Technical Report", "report_number": "NREL/TP-1",
               "links": [{"rel": "citation", "href": "https://www.osti.gov/biblio/99"}, {"rel": "fulltext", "href": "https://www.osti.gov/servlets/99"}]}
    ((row, s),) = mapped(map_source("osti", raw(spark, payload), task_pattern=MENTION, tasks=TASKS))
    assert row["identity_key"] == "10.5072/pub" and row["source_id"] == "99"
    assert s["authors"] == [{"name": "Hall, Matthew", "orcid": "0000-0002-0398-8320", "affiliation": "NREL, Golden, CO"}]
    assert s["keywords"] == ["ENGINEERING", "WIND ENERGY", "29 ENERGY PLANNING, POLICY, AND ECONOMY"]
    assert s["access_status"] == "open" and s["resource_kind"] == "report" and s["published_date"] == "2021-01-01"
    assert s["task"] == ["task-54", "task-59"] and s["report_number"] == "NREL/TP-1"
    assert [r["relation"] for r in s["related_identifiers"]] == ["IsIdenticalTo", "IsIdenticalTo", "IsVariantFormOf"]


def test_wdh_access_matrix_hosts_and_single_resource(spark):
    payload = {"_source": {"identifier": "p/d", "accessLevel": "restricted public", "lastUpdated": "2024-01-01",
                           "dapFileSummary": {"count": 1750000, "types": ["nc", "csv"], "begins": "2020"},
                           "contactPoint": [{"fn": "A B", "hasOrg": "X"}], "project": {"title": "P", "keywords": ["k"]},
                           "references": [{"referenceURL": "https://a2e.energy.gov/doc?x=1"}]}}
    ((row, s),) = mapped(map_source("wdh", raw(spark, payload, url="https://a2e.energy.gov/ds/p/d")))
    assert row["identity_key"] == "wdh|p/d" and row["source_key"] == "2024-01-01~m2"
    assert s["url"] == "https://wdh.energy.gov/ds/p/d" and s["access_status"] == "registration-required"
    assert len(s["resources"]) == 2 and s["resources"][1]["url"] == "https://wdh.energy.gov/doc?x=1"
    assert s["extra"]["wdh_file_count"] == 1750000 and s["extra"]["temporal_coverage_end"] is None
    assert s["extra"]["wdh_file_types"] == ["csv", "nc"] and s["container"] == "P" and s["keywords"] == ["k"]


def test_task_pages_use_the_registry_answer(spark):
    page = {"url": "https://w.org/t", "classified_as": "publication-list", "classification_method": "llm", "classification_evidence": "m"}
    dc = {"doi": "10.5072/A", "agency": "datacite", "task": ["task-34"], "pages": [page], "resolution": {"data": {"attributes": {
        "titles": [{"title": "T"}], "creators": [{"name": "N"}], "types": {"resourceTypeGeneral": "Text"}, "publicationYear": 2020,
        "rightsList": [{"rightsIdentifier": "cc0-1.0"}]}}}}
    cr = {"doi": "10.5072/B", "agency": "crossref", "task": [], "pages": [], "resolution": {"message": {
        "title": ["U"], "author": [{"family": "F", "given": "G"}], "issued": {"date-parts": [[2021, 3]]}, "type": "report"}}}
    out, errors = map_source("task_pages", raw(spark, dc, cr, {"doi": "10.5072/c", "agency": "x"}), tasks=TASKS)
    by = {r["identity_key"]: (r, json.loads(r["source"])) for r in out.collect()}
    row, s = by["10.5072/a"]
    assert s["task"] == ["task-59"] and s["license_id"] == "cc-zero" and s["published_date"] == "2020" and s["resource_kind"] == "publication"
    assert s["source_urls"] == ["https://doi.org/10.5072/a", "https://w.org/t"] and s["extra"]["llm_influenced"] is True
    assert row["provenance"]["doi"]["source_system"] == "task_pages"
    _, s = by["10.5072/b"]
    assert s["authors"][0]["name"] == "F, G" and s["published_date"] == "2021-03" and s["resource_kind"] == "report"
    assert errors.count() == 1


def test_registry_refuses_two_mappers_of_one_name():
    assert set(MAPPERS) >= {"zenodo", "datacite", "crossref", "github", "osti", "wdh", "task_pages"}
    with pytest.raises(ValueError):
        register_mapper("zenodo")(lambda raw: raw)
