"""Email normalisation and syntax, and the product active flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidyledger.functions.text import strip, stripped_or_null

# Address syntax (dot-atom local part, host name of at least two labels, letter at the end),
# length limits, and last labels reserved for special use. Letters and digits of any script are accepted.
_ATOM = r"[\p{L}\p{M}\p{N}!#$%&'*+/=?^_`{|}~-]+"
_LABEL = r"[\p{L}\p{N}](?:[\p{L}\p{M}\p{N}-]{0,61}[\p{L}\p{M}\p{N}])?"
EMAIL_PATTERN = rf"^{_ATOM}(?:\.{_ATOM})*@(?:{_LABEL}\.)+(?:{_LABEL})$"
EMAIL_LAST_CHARACTER = r"\p{L}$"
RESERVED_LAST_LABELS = ("arpa", "invalid", "local", "localhost", "onion", "test")
MAX_EMAIL, MAX_LOCAL, MAX_DOMAIN = 254, 64, 253

# Texts that mean an active product.
ACTIVE = ("Y", "YES", "TRUE", "1")


# The numbers of the encoding of host names (Punycode).
_PREFIX, _BASE, _TMIN, _TMAX, _SKEW, _DAMP, _FIRST_BIAS, _FIRST = 4, 36, 1, 26, 38, 700, 72, 128
MAX_LABEL = 63


#: Number of digits of the delta ``x.delta`` under the bias ``x.bias``.
_DIGITS = f"""aggregate(sequence({_BASE}, {10 * _BASE}, {_BASE}), named_struct('q', x.delta, 'n', 1, 'done', false), (l, k) -> get(transform(
  array(cast(greatest({_TMIN}, least({_TMAX}, k - x.bias)) as bigint)),
  t -> if(l.done or l.q < t, named_struct('q', l.q, 'n', l.n, 'done', true),
    named_struct('q', (l.q - t) div ({_BASE} - t), 'n', l.n + 1, 'done', false))), 0), l -> l.n)"""

#: The bias after that delta, the ``x.handled`` + 1st code point.
_ADAPTED = f"""aggregate(sequence(1, 8), get(transform(array(x.delta div if(x.handled = basic, {_DAMP}, 2)),
    d -> named_struct('d', d + d div (x.handled + 1), 'k', 0)), 0),
  (a, i) -> if(a.d > {(_BASE - _TMIN) * _TMAX // 2}, named_struct('d', a.d div {_BASE - _TMIN}, 'k', a.k + {_BASE}), a),
  a -> cast(a.k + (a.d * {_BASE - _TMIN + 1}) div (a.d + {_SKEW}) as int))"""

#: Length of the code points ``p`` once encoded: they are taken in ascending order from U+0080; for each, one pass over all
#: of them adds up the deltas and the digits they take.
_ENCODED = f"""p -> get(transform(array(size(filter(p, c -> c < {_FIRST}))), basic -> aggregate(
  array_sort(array_distinct(filter(p, c -> c >= {_FIRST}))),
  named_struct('next', {_FIRST}L, 'delta', 0L, 'bias', {_FIRST_BIAS}, 'handled', cast(basic as bigint), 'n', 0),
  (s, point) -> aggregate(p,
    named_struct('next', point, 'delta', s.delta + (point - s.next) * (s.handled + 1), 'bias', s.bias, 'handled', s.handled, 'n', s.n),
    (x, c) -> if(c = point,
      named_struct('next', point, 'delta', 0L, 'bias', {_ADAPTED}, 'handled', x.handled + 1, 'n', x.n + {_DIGITS}),
      named_struct('next', point, 'delta', x.delta + if(c < point, 1L, 0L), 'bias', x.bias, 'handled', x.handled, 'n', x.n)),
    x -> named_struct('next', x.next + 1, 'delta', x.delta + 1, 'bias', x.bias, 'handled', x.handled, 'n', x.n)),
  s -> {_PREFIX} + basic + if(basic > 0, 1, 0) + s.n)), 0)"""

#: The same of a label in any script.
_LENGTH = (
    "label -> if(label rlike r'^\\p{{ASCII}}*$', length(label), "
    "get(transform(array(transform(filter(split(label, ''), c -> c <> ''), c -> cast(ascii(c) as bigint))), {}), 0))"
).format(_ENCODED)


def encoded_length(label: Column) -> Column:
    """Length of a host name's label as it is sent: itself in ASCII, else ``xn--`` and its Punycode."""
    return F.get(F.call_function("transform", F.array(label), F.expr(_LENGTH)), F.lit(0))


def normalize_email(c: Column) -> Column:
    """Lower case, stripped; blank is NULL."""
    return F.lower(stripped_or_null(c))


def _host_fits(domain: Column) -> Column:
    """Whether every label, and the whole host name with its dots, is short enough once encoded."""
    lengths = F.call_function("transform", F.split(F.lower(domain), r"\."), F.expr(_LENGTH))
    fits = f"n -> forall(n, size -> size <= {MAX_LABEL}) and aggregate(n, -1, (sum, size) -> sum + size + 1) <= {MAX_DOMAIN}"
    return F.get(F.call_function("transform", F.array(lengths), F.expr(fits)), F.lit(0))


def is_valid_email(c: Column) -> Column:
    """Syntax only, no DNS. Missing is false."""
    s = strip(c)
    local = F.substring_index(s, "@", 1)
    domain = F.substring_index(s, "@", -1)
    return F.coalesce(
        s.rlike(EMAIL_PATTERN)
        & s.rlike(EMAIL_LAST_CHARACTER)
        & (F.length(s) <= MAX_EMAIL)
        & (F.length(local) <= MAX_LOCAL)
        & (F.length(domain) <= MAX_DOMAIN)
        & ~F.lower(F.substring_index(domain, ".", -1)).isin(*RESERVED_LAST_LABELS)
        & F.when(domain.rlike(r"^\p{ASCII}*$"), F.lit(True)).otherwise(_host_fits(domain)),
        F.lit(False),
    )


def is_active(c: Column) -> Column:
    """Y, YES, TRUE and 1 in any case; everything else, NULL included, is false."""
    return F.coalesce(F.upper(strip(c)).isin(*ACTIVE), F.lit(False))
