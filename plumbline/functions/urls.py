"""URL expressions on columns, inside the JVM. Only hosts and characters that need tables of their own (IDNA, IP literals, escaping) go through Arrow UDFs, and only where a row has them."""

from __future__ import annotations

import ipaddress
import re
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that only track (besides utm_*), suffixes of hosts that are not public,
# second levels of country domains, characters that stay as they are in a path, query and fragment.
TRACKING_KEYS = ["fbclid", "gclid", "mc_cid", "mc_eid", "ref", "source"]
PRIVATE_SUFFIXES = (".localhost", ".local", ".internal", ".lan", ".home.arpa")
COUNTRY_SECOND_LEVELS = ["ac", "co", "com", "edu", "gov", "net", "org"]
# Suffixes of hosts that unrelated tenants share.
SHARED_HOSTS = (
    "amazonaws.com appspot.com azurewebsites.net azureedge.net backblazeb2.com blob.core.windows.net blogspot.com box.com canva.site carrd.co "
    "cloudfront.net cloudfunctions.net digitaloceanspaces.com docs.google.com drive.google.com dropbox.com facebook.com firebaseapp.com ghost.io "
    "github.io githubusercontent.com gitlab.io groups.google.com hashnode.dev herokuapp.com instagram.com issuu.com linkedin.com linodeobjects.com "
    "medium.com myshopify.com netlify.app notion.site notion.so onrender.com onedrive.live.com pages.dev r2.cloudflarestorage.com r2.dev "
    "readthedocs.io reddit.com run.app scribd.com sharepoint.com sites.google.com slideshare.net storage.googleapis.com substack.com surge.sh "
    "tumblr.com twitter.com vercel.app wasabisys.com web.app weebly.com wixsite.com workers.dev wordpress.com x.com youtube.com youtu.be"
).split()
SAFE_IN_PATH = "/@:-._~!$&'*+,;=%"
SAFE_IN_QUERY = "=&?/:@-._~!$'*+,;%"
SAFE_IN_FRAGMENT = "?/:@-._~!$&'*+,;=%"


def host(url: Column | str) -> Column:
    """Lower-case host without port and trailing dot; null if the url has none."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), r"\.$", ""), F.lit(""))


def path(url: Column | str) -> Column:
    p = F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(p == "", "/").otherwise(p)


def query(url: Column | str) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def standard_port(url: Column | str) -> Column:
    """True without a port, or with 80 or 443."""
    return F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#:]*:?(\d*)", 1).isin("", "80", "443")


def is_pdf(url: Column | str) -> Column:
    return F.lower(path(url)).endswith(".pdf")


_WHOLE = r"(?s)^\s*([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
_AUTHORITY = r"^(\[[^\[\]@]+\]|[^:@\[\]]+)(?::(\d*))?$"


def _part(url: Column | str, i: int) -> Column:
    """Scheme, authority, path, query with its sign, fragment with its sign; empty where there is none."""
    return F.regexp_extract(F.rtrim(url), _WHOLE, i)


def _netloc(url: Column | str, host_of, port_ok) -> Column:
    """Host and, if it is not the scheme's own, port; null with credentials, another scheme or a host or port that does not pass."""
    scheme, authority = F.lower(_part(url, 1)), _part(url, 2)
    name = host_of(F.regexp_replace(F.lower(F.regexp_extract(authority, _AUTHORITY, 1)), r"\.$", ""))
    port = F.regexp_extract(authority, _AUTHORITY, 2)
    own = (port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443"))
    shown = F.when(own, name).otherwise(F.concat(name, F.lit(":"), port))
    return F.when(scheme.isin("http", "https") & port_ok(port) & (name != ""), shown)


def _standard(url: Column | str) -> Column:
    return _netloc(url, lambda name: name, lambda port: port.isin("", "80", "443"))


def _rooted(path_col: Column) -> Column:
    return F.when(path_col == "", "/").otherwise(path_col)


def _pairs(url: Column | str) -> Column:
    """The decoded (k, v) pairs of the query in order; a name without a value has an empty one."""
    decode = lambda x: F.coalesce(F.try_url_decode(x), F.translate(x, "+", " "))
    fields = F.filter(F.split(F.substring(_part(url, 4), 2, 1_000_000_000), "&"), lambda p: p != "")
    name = lambda p: F.regexp_extract(p, "(?s)^([^=]*)", 1)
    value = lambda p: F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)
    return F.transform(fields, lambda p: F.struct(decode(name(p)).alias("k"), decode(value(p)).alias("v")))


def _query(pairs: Column) -> Column:
    """Pairs as a query with its sign, in the encoding of forms."""
    encode = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    text = F.array_join(F.transform(pairs, lambda p: F.concat(encode(p["k"]), F.lit("="), encode(p["v"]))), "&")
    return F.when(F.size(pairs) > 0, F.concat(F.lit("?"), text)).otherwise("")


def search_url(url: Column | str) -> Column:
    """Normal form of a search result: standard port dropped, query decoded and encoded again, no fragment. Null for what is no http(s) url or names another port or credentials."""
    return F.concat(F.lower(_part(url, 1)), F.lit("://"), _standard(url), _rooted(_part(url, 3)), _query(_pairs(url)))


def dedupe_key(url: Column | str) -> Column:
    """Key under which two urls count as the same page: as ``search_url``, without tracking keys, pairs sorted, no last slash, lower case."""
    kept = F.filter(_pairs(url), lambda p: ~F.lower(p["k"]).startswith("utm_") & ~F.lower(p["k"]).isin(*TRACKING_KEYS))
    trimmed = F.regexp_replace(_part(url, 3), r"/+$", "")
    return F.lower(F.concat(_part(url, 1), F.lit("://"), _standard(url), _rooted(trimmed), _query(F.array_sort(kept))))


def state_url(url: Column | str) -> Column:
    """The third form, which binds evidence to an attempt: path and query as written, no fragment, standard port dropped."""
    asked = _part(url, 4)
    return F.concat(F.lower(_part(url, 1)), F.lit("://"), _standard(url), _rooted(_part(url, 3)), F.when(asked == "?", "").otherwise(asked))


def is_shared_host(host_col: Column | str) -> Column:
    """An IP literal or a host that unrelated tenants share; false for null and blank."""
    name = F.regexp_replace(F.lower(F.trim(host_col)), r"\.$", "")
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    literal = name.rlike(rf"^{octet}(?:\.{octet}){{3}}$") | name.rlike(r"^[0-9a-f:]*:[0-9a-f:.]*$")
    return F.coalesce((name != "") & (literal | F.arrays_overlap(parent_domains(name), F.array(*map(F.lit, SHARED_HOSTS)))), F.lit(False))


def parent_domains(host_col: Column | str) -> Column:
    """The host and every domain above it, as an array: a suffix join becomes an equi-join."""
    labels = F.split(host_col, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def registrable_label(host_col: Column | str) -> Column:
    """The label a host is registered under; empty for a single label and for hosts that unrelated tenants share."""
    labels = F.filter(F.split(F.lower(host_col), r"\."), lambda x: x != "")
    n = F.size(labels)
    country = (n >= 3) & (F.length(F.try_element_at(labels, F.lit(-1))) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*COUNTRY_SECOND_LEVELS)
    return F.when((n < 2) | is_shared_host(host_col), "").when(country, F.try_element_at(labels, F.lit(-3))).otherwise(F.try_element_at(labels, F.lit(-2)))


def last_two_labels(host_col: Column | str) -> Column:
    labels = F.split(host_col, r"\.")
    return F.when(F.size(labels) <= 2, F.col(host_col) if isinstance(host_col, str) else host_col).otherwise(F.array_join(F.slice(labels, F.size(labels) - 1, F.lit(2)), "."))


#: A host of plain labels, and what looks like a number in any base.
_PLAIN_HOST = r"^(?=.{1,253}$)[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?)*$"
_NUMBER_HOST = r"^(?:[0-9.]+|0x[0-9a-f.x]+)$"


def rare_host(name: object) -> str | None:
    """The normal form of a host that is no plain name: a global IP literal, or an international name in ASCII; else None."""
    if not isinstance(name, str):
        return None
    bracketed = name.startswith("[")
    try:
        address = ipaddress.ip_address(name.strip("[]") if bracketed else name)
    except ValueError:
        address = None
    if address is not None:
        form = f"[{address.compressed}]" if address.version == 6 else address.compressed
        return form if address.is_global else None
    if bracketed or name.isascii():
        return None
    try:
        ascii_name = name.encode("idna").decode("ascii")
    except UnicodeError:
        return None
    return ascii_name if re.match(_PLAIN_HOST, ascii_name) and not re.match(_NUMBER_HOST, ascii_name) else None


def _rare_host_udf():
    @F.pandas_udf("string")
    def form(name: pd.Series) -> pd.Series:
        return name.map(rare_host, na_action="ignore")

    return form


def _escaped(text: Column, safe: str) -> Column:
    """Percent escapes for everything but letters, digits and ``safe``; text that needs none stays in the JVM."""
    plain = text.rlike("^[A-Za-z0-9_.~" + re.escape(safe) + r"\-]*$")

    @F.pandas_udf("string")
    def escape(rare: pd.Series) -> pd.Series:
        return rare.map(lambda t: quote(t, safe), na_action="ignore")

    return F.when(plain, text).otherwise(escape(F.when(~plain, text)))


def _public_host(name: Column) -> Column:
    plain = name.rlike(_PLAIN_HOST) & ~name.rlike(_NUMBER_HOST)
    private = (name == "localhost") | name.rlike("(?:" + "|".join(map(re.escape, PRIVATE_SUFFIXES)) + ")$")
    return F.when(private, None).when(plain, name).otherwise(_rare_host_udf()(F.when(~plain & ~private, name)))


def public_url(url: Column | str) -> Column:
    """The normal form of a public http(s) url, or null: no credentials, no control characters, no local, private or numeric host."""
    c = F.col(url) if isinstance(url, str) else url
    port_ok = lambda p: (p == "") | (p.try_cast("int").between(1, 65535))
    tail = lambda i, safe: F.when(F.length(_part(c, i)) > 1, F.concat(F.substring(_part(c, i), 1, 1), _escaped(F.substring(_part(c, i), 2, 1_000_000_000), safe))).otherwise("")
    whole = F.concat(F.lower(_part(c, 1)), F.lit("://"), _netloc(c, _public_host, port_ok), _escaped(_rooted(_part(c, 3)), SAFE_IN_PATH), tail(4, SAFE_IN_QUERY), tail(5, SAFE_IN_FRAGMENT))
    return F.when(~F.trim(c).rlike(r"[\x00-\x1f\x7f]"), whole)
