"""Clients for what lies outside: connection profiles, harvests over HTTP, object stores where their library is there.

Each is a function that the readers and writers run on the executors.
"""

from __future__ import annotations

import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Mapping
from xml.etree import ElementTree as ET

OAI, DC = "{http://www.openarchives.org/OAI/2.0/}", "{http://purl.org/dc/elements/1.1/}"


def profile(settings: Mapping, user: str) -> dict[str, str]:
    """One user's connection of a store's settings (endpoint_url, region_name, and per user access_key and secret_key)."""
    missing = [k for k in ("endpoint_url", user) if k not in settings]
    if missing:
        raise KeyError(f"the settings lack {', '.join(missing)}")
    own = settings[user]
    return {"endpoint_url": settings["endpoint_url"], "region_name": settings.get("region_name", ""), "access_key": own["access_key"], "secret_key": own["secret_key"]}


def hadoop_settings(connection: Mapping[str, str], bucket: str) -> dict[str, str]:
    """The connection as Spark settings for one bucket of the S3A file system."""
    at = f"spark.hadoop.fs.s3a.bucket.{bucket}."
    out = {at + "endpoint": connection["endpoint_url"], at + "access.key": connection["access_key"], at + "secret.key": connection["secret_key"]}
    return out | ({at + "endpoint.region": connection["region_name"]} if connection.get("region_name") else {})


def open_url(url: str) -> bytes:
    with urllib.request.urlopen(url, timeout=60) as answer:  # noqa: S310 - the address is the caller's
        return answer.read()


def _pages(base: str, get: Callable[[str], bytes], **query: str) -> Iterator[ET.Element]:
    """Answers to a harvesting request, one after the other by their resumption tokens."""
    while query:
        root = ET.fromstring(get(f"{base}?{urllib.parse.urlencode(query)}"))
        error = root.find(f"{OAI}error")
        if error is not None:
            if error.get("code") == "noRecordsMatch":
                return
            raise ValueError(f"{error.get('code')}: {error.text}")
        yield root
        token = next((t.text for t in root.iter(f"{OAI}resumptionToken") if t.text), None)
        query = {"verb": query["verb"], "resumptionToken": token} if token else {}


def harvest_sets(base: str, get: Callable[[str], bytes] = open_url) -> list[tuple[str, str]]:
    """(setspec, setname) of a repository."""
    return [(s.findtext(f"{OAI}setSpec"), s.findtext(f"{OAI}setName")) for page in _pages(base, get, verb="ListSets") for s in page.iter(f"{OAI}set")]


def harvest_records(base: str, get: Callable[[str], bytes] = open_url) -> Callable[[str], Iterator[dict]]:
    """What ``readers.harvest`` calls for a set: its records that aren't deleted."""

    def fetch(spec: str) -> Iterator[dict]:
        for page in _pages(base, get, verb="ListRecords", metadataPrefix="oai_dc", set=spec):
            for r in page.iter(f"{OAI}record"):
                head = r.find(f"{OAI}header")
                if head.get("status") != "deleted":
                    yield {"identifier": head.findtext(f"{OAI}identifier"), "source": next((e.text for e in r.iter(f"{DC}source")), None), "titles": [e.text for e in r.iter(f"{DC}title")]}

    return fetch


def _store(connection: Mapping[str, str]):
    try:
        import boto3
    except ImportError as e:
        raise ImportError("object stores need the boto3 library, or functions of your own in its place") from e
    return boto3.client("s3", endpoint_url=connection["endpoint_url"], region_name=connection.get("region_name") or None, aws_access_key_id=connection["access_key"], aws_secret_access_key=connection["secret_key"])


def object_lister(connection: Mapping[str, str], client: Callable = _store) -> Callable[[str, str], Iterator[dict]]:
    """What ``readers.list_objects`` calls for a bucket and prefix."""

    def lister(bucket: str, prefix: str) -> Iterator[dict]:
        s3 = client(connection)
        for page in s3.get_paginator("list_objects_v2").paginate(Bucket=bucket, Prefix=prefix):
            for o in page.get("Contents", ()):
                tags = {t["Key"]: t["Value"] for t in s3.get_object_tagging(Bucket=bucket, Key=o["Key"]).get("TagSet", ())}
                yield {"key": o["Key"], "last_modified": o["LastModified"], "size": o["Size"], "storage_class": o.get("StorageClass")} | {k: tags.get(k) for k in ("uuid", "checksum_md5")}

    return lister


def object_writer(connection: Mapping[str, str], bucket: str, client: Callable = _store) -> tuple[Callable, Callable, Callable]:
    """``head``, ``put`` and ``delete``, which ``writers.upload`` and ``writers.delete_keys`` call."""

    def head(key: str) -> dict | None:
        found = client(connection).list_objects_v2(Bucket=bucket, Prefix=key).get("Contents", ())
        return next(({"size": o["Size"], "last_modified": o["LastModified"]} for o in found if o["Key"] == key), None)

    def put(path: str, key: str, tags: str) -> None:
        client(connection).upload_file(path, bucket, key, ExtraArgs={"Tagging": tags})

    def delete(key: str) -> None:
        client(connection).delete_object(Bucket=bucket, Key=key)

    return head, put, delete
