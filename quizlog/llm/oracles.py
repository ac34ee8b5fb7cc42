"""DuckDB twins of the queries that SQL can express.

Operators 2, 3, 4, 7, 8, 9 and 10 rest on learned models, XXH64, a tokenizer
or a search over packings; they are tested against brute force instead.
"""

from __future__ import annotations

from quizlog.llm import chat_format, decontaminate, license_scan, prefix_trie, ranked_search, url_filter

_UPPER, _LOWER = license_scan._UPPER, license_scan._LOWER
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}')"


def _list(words: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words.split()) + "]"


def decontaminate_sql() -> str:
    """Every alignment of a document with an item, found by equal words, its
    longest stretch with the share of equal words, and the longest of each
    document and item."""
    n, low, share = decontaminate.MIN_WORDS, decontaminate.MIN_ITEM_WORDS, decontaminate.IDENTITY
    alone = "".join(f"\\x{{{a:X}}}-\\x{{{z:X}}}" for a, z in decontaminate.UNSPACED_CHARS)
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[{alone}]|[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F{alone}]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id, {words} AS w FROM benchmark),
dw AS (SELECT rid, doc_id, unnest(w) AS x, unnest(range(len(w))) AS p FROM d),
bw AS (SELECT bid, item_id, len(w) AS size, CASE WHEN len(w) < {low} THEN 1.0 ELSE {share} END AS share,
       CASE WHEN len(w) < {low} THEN len(w) ELSE least({n}, len(w)) END AS need, unnest(w) AS x, unnest(range(len(w))) AS p FROM b),
al AS (SELECT rid, doc_id, bid, item_id, share, need, dw.p - bw.p AS zero, bw.p AS p FROM dw JOIN bw USING (x)),
cand AS (SELECT rid, bid, zero FROM al GROUP BY rid, bid, zero, share, need HAVING count(*) >= share * need - 1e-9),
m AS (SELECT al.*, row_number() OVER (PARTITION BY rid, bid, zero ORDER BY p) AS r FROM al JOIN cand USING (rid, bid, zero)),
st AS (SELECT s.rid, s.doc_id, s.bid, s.item_id, s.need, s.zero, s.p AS a, e.p AS z, e.r - s.r + 1 AS same
       FROM m s JOIN m e ON s.rid = e.rid AND s.bid = e.bid AND s.zero = e.zero AND s.p <= e.p
       WHERE e.r - s.r + 1 >= s.share * (e.p - s.p + 1) - 1e-9),
best AS (SELECT *, row_number() OVER (PARTITION BY rid, bid ORDER BY z - a DESC, same DESC, zero + a, a) AS k
         FROM (SELECT *, row_number() OVER (PARTITION BY rid, bid, zero ORDER BY z - a DESC, z, a) AS j FROM st) WHERE j = 1)
SELECT doc_id, item_id, zero + a AS doc_word, a AS item_word, z - a + 1 AS n_words, same AS n_equal
FROM best WHERE k = 1 AND z - a + 1 >= need"""


def chat_sql() -> str:
    t = chat_format.Template()
    escaped, role = "body", "role"
    for control, letter in t.codes().items():
        escaped = f"replace({escaped}, {_char(control)}, chr(27) || '{letter}')"
        role = f"replace({role}, {_char(control)}, chr(27) || '{letter}')"
    role = f"replace({role}, chr(10), chr(27) || 'n')"
    head, tail = t.open.split("{role}")
    fixed = len(head) + len(tail) + len(t.close)
    loss = ", ".join(f"'{r}'" for r in sorted(t.loss_roles))
    # the state after a turn follows from its role alone while no turn was bad
    before = {}
    for state, moves in t.order.items():
        before[state] = sorted({r for m in t.order.values() for r, to in m.items() if to == state})
    ok = [f"(n > 0 AND was IN ({', '.join(repr(r) for r in before[s])}) AND role IN ({', '.join(repr(r) for r in moves)}))"
          for s, moves in t.order.items() if before[s]]
    ok.append(f"(n = 0 AND role IN ({', '.join(repr(r) for r in t.order[t.start])}))")
    ends = sorted({r for m in t.order.values() for r, to in m.items() if to in t.ends})
    probe = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in chat_format.PROBE)
    return f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS body FROM
  (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES {probe}) v(conv_id, turn, role, text))),
o AS (SELECT *, row_number() OVER w - 1 AS n, lag(role) OVER w AS was, {escaped} AS esc, {role} AS role_esc FROM c
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body)),
g AS (SELECT *, {' OR '.join(ok)} AS fine FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || body || chr(10), '' ORDER BY n)) AS turns_sha256,
  cast(coalesce(sum(length(body)) FILTER (role IN ({loss})), 0) AS bigint) AS loss_chars,
  sha256(coalesce(string_agg(body, '' ORDER BY n) FILTER (role IN ({loss})), '')) AS loss_sha256,
  cast(sum(length(esc) + length(role_esc) + {fixed}) AS bigint) AS formatted_chars,
  bool_and(coalesce(fine, false)) AND arg_max(role, n) IN ({', '.join(repr(r) for r in ends)}) AS valid,
  min(n) FILTER (NOT coalesce(fine, false)) AS first_bad_turn
FROM g GROUP BY conv_id"""


def _char(text: str) -> str:
    return "chr(27)" if text == chat_format.ESCAPE else "'" + text.replace("'", "''") + "'"


def license_sql() -> str:
    phrases = ", ".join(f"({_list(p)}, '{label}')" for p, label in license_scan.PHRASES.items())
    templates = ", ".join(f"(list_distinct({_list(text)}), '{label}')" for label, text in license_scan.TEMPLATES)
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words('text')} AS w,
  translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
ph(p, label) AS (VALUES {phrases}),
pos AS (SELECT rid, w, unnest(range(len(w))) AS i FROM d),
places AS (SELECT rid, i, label FROM pos JOIN ph ON w[i + 1] = p[1] AND w[i + 1 : i + len(p)] = p),
base AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY rid),
te(tw, label) AS (VALUES {templates}),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT rid, list_distinct(regexp_extract_all(line, '{_ALNUM}')) AS b FROM ln),
hit AS (SELECT rid, label, len(list_intersect(b, tw)) / len(tw) AS share FROM lw CROSS JOIN te
        WHERE len(list_intersect(b, tw)) >= {license_scan.CONTAINMENT} * len(tw) - 1e-9),
both_ AS (SELECT rid, label FROM places UNION SELECT rid, label FROM hit),
lab AS (SELECT rid, string_agg(label, ',' ORDER BY label) AS labels FROM both_ GROUP BY rid),
top AS (SELECT rid, max(share) AS share FROM hit GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, cast(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(share, 0) END AS double) AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN lab USING (rid) LEFT JOIN top USING (rid)"""


def search_sql() -> str:
    """Every document's score for every item by its formula, then the best."""
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_words('text')} AS w FROM documents),
st AS (SELECT count(*) AS nn, cast(sum(len(w)) AS bigint) AS ll FROM d WHERE len(w) > 0),
tf AS (SELECT rid, x, count(*) AS tf FROM (SELECT rid, unnest(w) AS x FROM d) GROUP BY rid, x),
df AS (SELECT x, cast(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS bigint) AS w FROM tf CROSS JOIN st GROUP BY x, nn),
b AS (SELECT row_number() OVER () AS bid, item_id, {_words('text')} AS bw FROM benchmark),
q AS (SELECT DISTINCT bid, item_id, unnest(bw) AS x FROM b),
m AS (SELECT rid, doc_id, 100 - 50 + ((50 * len(w) * nn) // ll) AS m FROM d CROSS JOIN st WHERE len(w) > 0),
s AS (SELECT bid, item_id, rid, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS bigint) AS score
      FROM q JOIN df USING (x) JOIN tf USING (x) JOIN m USING (rid) GROUP BY bid, item_id, rid, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY bid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, cast(rank AS integer) AS rank, doc_id, score FROM r WHERE rank <= {ranked_search.TOP}"""


def trie_sql() -> str:
    """Nodes by grouping whole prefixes, subtrees by joining every node with
    all its prefixes."""
    # crc32 of the decimal id: eight shifts a byte over the reflected polynomial
    shift = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = "list_transform(string_split(cast(conv_id AS varchar), ''), lambda x: cast(ascii(x) AS bigint))"
    crc = f"xor(4294967295, list_reduce(list_concat([4294967295::bigint], {codes}), lambda crc, byte: {shift}))"
    g = prefix_trie.GROUP
    return f"""WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'r': r, 't': t}} ORDER BY turn NULLS FIRST, r, t) AS own FROM t GROUP BY conv_id),
h AS (SELECT *, {crc} % {prefix_trie.BORROW} AS h FROM o),
s AS (SELECT h.conv_id, list_concat(coalesce(l.own, [])[1 : h.h], h.own[h.h + 1 : len(h.own)]) AS s
      FROM h LEFT JOIN o l ON l.conv_id = h.conv_id - h.conv_id % {g}),
m AS (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM s),
n AS (SELECT s[1 : depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(cast(conv_id AS varchar), ',' ORDER BY conv_id) FILTER (len(s) = depth), '')) AS ends_sha256
  FROM m GROUP BY s[1 : depth], depth),
kids AS (SELECT k[1 : depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
  CASE WHEN depth > 0 THEN (n_convs - 1) * len(regexp_extract_all(n.k[depth].t, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS own_saved
  FROM n LEFT JOIN kids ON kids.k = n.k),
up AS (SELECT k[1 : d] AS k, n_children, own_saved FROM (SELECT k, n_children, own_saved, unnest(range(depth + 1)) AS d FROM v)),
sub AS (SELECT k, count(*) FILTER (n_children = 0) AS n_leaves, cast(sum(own_saved) AS bigint) AS saved_tokens FROM up GROUP BY k)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN sub ON sub.k = v.k LEFT JOIN n p ON v.depth > 0 AND p.k = v.k[1 : v.depth - 1]"""


def url_sql() -> str:
    """The rules, both models order by order, the cut over every step from the
    lowest to the highest, and each URL's score."""
    u, k = url_filter, url_filter.ORDER
    low = lambda c: f"translate({c}, '{_UPPER}', '{_LOWER}')"
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for v, h, p in u.by_length(u.RULES)]
    name = " ".join(f"WHEN {f} THEN '{n}'" for f, n, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    parts = u.PARTS.replace("'", "''")
    levels = []
    for i in range(k + 1):
        gram = f"g[{k - i + 1} : {k + 1}]"
        before = f"p{i - 1}" if i else "(SELECT 1.0::DOUBLE / (count(DISTINCT g[-1]) + 1) AS pa, 1.0::DOUBLE / (count(DISTINCT g[-1]) + 1) AS pr FROM gc)"
        join = f"JOIN {before} l ON l.s = x.s[2:]" if i else f"CROSS JOIN {before} l"
        prob = lambda c: f"CASE WHEN n{c} > 0 THEN ({c} + t{c} * l.p{c}) / (n{c} + t{c}) ELSE l.p{c} END AS p{c}"
        levels.append(f"""x{i} AS (SELECT {gram} AS s, sum(a)::DOUBLE AS a, sum(r)::DOUBLE AS r FROM gc GROUP BY 1),
p{i} AS (SELECT x.s, {prob('a')}, {prob('r')} FROM (SELECT *, sum(a) OVER w AS na, sum(r) OVER w AS nr,
  count(*) FILTER (a > 0) OVER w AS ta, count(*) FILTER (r > 0) OVER w AS tr FROM x{i} WINDOW w AS (PARTITION BY s[1:{i}])) x {join})""")
    return f"""WITH d AS (SELECT row_number() OVER () AS uid, page_id, coalesce(url, '') AS url FROM pages),
e AS (SELECT *, {low(f"regexp_extract(url, '{parts}', 1)")} AS host, regexp_extract(url, '{parts}', 2) AS path,
  contains('{u.KEPT_OUT}', md5(url)[1:1]) AS kept_out FROM d),
f AS (SELECT *, CASE {name} END AS rule, CASE {verdict} END AS by_rule FROM e),
c AS (SELECT *, repeat(chr(2), {k}) || {low('url')} || chr(3) AS t FROM f),
gr AS (SELECT uid, by_rule, kept_out, t[i + 1 : i + {k + 1}] AS g FROM (SELECT *, unnest(range(length(t) - {k})) AS i FROM c)),
gc AS (SELECT g, count(*) FILTER (by_rule = 'allow' AND NOT kept_out) AS a, count(*) FILTER (by_rule = 'block' AND NOT kept_out) AS r
       FROM gr GROUP BY g),
{(',' + chr(10)).join(levels)},
sc AS (SELECT uid, sum(cast(floor((ln(pa) - ln(pr)) * {u.UNIT} + 0.5) AS bigint))::BIGINT AS v, count(*) AS n FROM gr JOIN p{k} ON g = s GROUP BY uid),
st AS (SELECT c.*, v, n, cast(floor(v / (n * {float(u.UNIT / u.STEPS)}::DOUBLE)) AS bigint) AS step FROM c JOIN sc USING (uid)),
ho AS (SELECT step, by_rule FROM st WHERE kept_out AND by_rule IS NOT NULL),
ct AS (SELECT count(*) FILTER (by_rule = 'allow') AS na, count(*) FILTER (by_rule = 'block') AS nr, min(step) AS lo, max(step) AS hi FROM ho),
cuts AS (SELECT unnest(range(least(lo, 0), greatest(hi + 1, 0) + 1)) AS t FROM ct WHERE na > 0 AND nr > 0),
er AS (SELECT t, sum(CASE WHEN by_rule = 'allow' AND step < t THEN nr WHEN by_rule = 'block' AND step >= t THEN na ELSE 0 END) AS bad
       FROM cuts CROSS JOIN ho CROSS JOIN ct GROUP BY t),
best AS (SELECT coalesce((SELECT t FROM er ORDER BY bad, abs(t), t LIMIT 1), 0) AS least)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN step >= least THEN 'allow' ELSE 'block' END) AS verdict,
  v / n::DOUBLE / {u.UNIT} AS score FROM st CROSS JOIN best"""


ORACLE = {
    "op1_decontaminate": decontaminate_sql(),
    "op5_chat_format": chat_sql(),
    "op6_license_scan": license_sql(),
    "op11_url_filter": url_sql(),
    "op12_ranked_search": search_sql(),
    "op13_prefix_trie": trie_sql(),
}
