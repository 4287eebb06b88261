"""DuckDB twins of the operators' queries, where SQL can express them."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SQL: dict[str, str] = {
    "op1_sharding": """WITH RECURSIVE step AS (
      SELECT b::BIGINT AS b, b::BIGINT AS c, 0 AS k FROM range(256) t(b)
      UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1
      FROM step WHERE k < 8),
    lookup AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8),
    bytes AS (SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, list_transform(
      regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
      FROM documents),
    sized AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
      lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS text_crc32
      FROM bytes, lookup),
    placed AS (SELECT *, sum(size) OVER (ORDER BY doc_id, size, text_crc32 ROWS UNBOUNDED PRECEDING)
      - size AS start, sum(size) OVER () AS total FROM sized),
    cut AS (SELECT *, ((2 * start + size) * 40 // (2 * total))::INTEGER AS shard FROM placed)
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
      (row_number() OVER (PARTITION BY shard ORDER BY start) - 1)::BIGINT AS slot,
      NULL::INTEGER AS grown_shard FROM cut""",
    "op3_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    m AS (SELECT html, max(page_id) AS last FROM p GROUP BY 1)
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(encode(html)) AS payload_digest,
      CASE WHEN strlen(html) >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END
        AS record_type,
      CASE WHEN strlen(html) >= 1000 AND page_id <> last THEN last END AS refers_to
    FROM p JOIN m USING (html)""",
    "op4_url_filter": f"""WITH p AS (SELECT page_id,
      translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}')
        AS host,
      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    r(h, q, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
      ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    f AS (SELECT page_id, max_by(h || q, length(h || q)) AS rule,
      max_by(verdict, length(h || q)) AS verdict
      FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY 1)
    SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM p LEFT JOIN f USING (page_id)""",
    "op5_decontamination": f"""WITH d AS (SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM documents),
    b AS (SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM benchmark),
    bi AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2))
      AS i FROM b WHERE len(w) > 0),
    bw AS (SELECT DISTINCT item_id::VARCHAR AS item, n, array_to_string(w[i:i + n - 1], ' ') AS k
      FROM bi),
    di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
      FROM d JOIN (SELECT DISTINCT n FROM bw) s ON len(w) >= n),
    hit AS (SELECT doc_id, i, n, item FROM
      (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM di) JOIN bw USING (n, k)),
    covered AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM
      (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
    items AS (SELECT doc_id, count(*)::BIGINT AS n_items,
      sha256(string_agg(item, ',' ORDER BY item)) AS digest
      FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
      coalesce(n_items, 0) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_substring_dedup": f"""WITH d AS (SELECT doc_id,
      regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
    p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20),
    k AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM p),
    later AS (SELECT doc_id, i FROM (SELECT doc_id, i,
      row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM k) WHERE n > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
    kept AS (SELECT doc_id, i, x FROM (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i,
      unnest(w) AS x FROM d) ANTI JOIN gone USING (doc_id, i)),
    texts AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM kept GROUP BY 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
      sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN texts USING (doc_id)""",
    "op9_exact_dedup": f"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points,
      regexp_replace(coalesce(text, ''), '{SPACE}', '', 'g') AS t FROM documents)
    SELECT doc_id, first_value(doc_id) OVER g AS keep_id,
      count(*) OVER (PARTITION BY t)::BIGINT AS group_size,
      doc_id = first_value(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY t ORDER BY points DESC, doc_id)""",
    "op11_line_dedup": f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l
      FROM documents),
    x AS (SELECT doc_id, i, l[i] AS line,
      regexp_replace(translate(l[i], '{UPPER}', '{LOWER}'), '^{SPACE}+|{SPACE}+$', '', 'g') AS k
      FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM d)),
    f AS (SELECT k, min(doc_id) AS first FROM x WHERE length(k) >= 10 GROUP BY 1),
    j AS (SELECT x.*, coalesce(first <> doc_id, false) AS gone FROM x LEFT JOIN f USING (k))
    SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM j GROUP BY 1""",
    "op12_collocations": f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS t FROM documents),
    w AS (SELECT lang, regexp_extract_all(t, '[^\\x20\\x09]+') AS w FROM p),
    g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM
      (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
       FROM w, range(1, 5) t(k) WHERE len(w) >= k)),
    f AS (SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY ALL),
    n AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY 1),
    c AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 30),
    cut AS (SELECT lang, phrase, a, j, array_to_string(w[:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
      FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
    s AS (SELECT cut.lang, cut.phrase, a, j, l.c AS l, r.c AS r,
      (2000000::HUGEINT * a // (l.c + r.c))::BIGINT AS score
      FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
    low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    part AS (SELECT lang, array_to_string(w[i:i + z - 1], ' ') AS phrase, max(a) AS around FROM
      (SELECT lang, w, a, z, unnest(range(1, k - z + 2)) AS i FROM c, range(2, 4) t(z) WHERE z < k)
      GROUP BY ALL),
    stay AS (SELECT low.* FROM low LEFT JOIN part USING (lang, phrase)
      WHERE around IS NULL OR 100 * around::HUGEINT < 80 * a::HUGEINT)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
      phrase, a, l, r, n, score FROM stay JOIN n USING (lang) QUALIFY rank <= 2000""",
    "op13_resampling": f"""WITH RECURSIVE step AS (
      SELECT b::BIGINT AS b, b::BIGINT AS c, 0 AS k FROM range(256) t(b)
      UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1
      FROM step WHERE k < 8),
    lookup AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8),
    d AS (SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}')) AS x FROM documents),
    b AS (SELECT unnest(regexp_extract_all(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}')) AS x FROM benchmark),
    words AS (SELECT x, list_transform(regexp_extract_all(hex(encode(x)), '..'),
      lambda h: ('0x' || h)::BIGINT) AS h FROM (SELECT x FROM d UNION SELECT x FROM b)),
    coded AS (SELECT x, xor(list_reduce(list_prepend(4294967295::BIGINT, h),
      lambda c, y: xor(c // 256, t[xor(c % 256, y) + 1])), 4294967295) % 10000 AS bucket FROM words, lookup),
    s AS (SELECT bucket, count(*) AS s FROM d JOIN coded USING (x) GROUP BY 1),
    t AS (SELECT bucket, count(*) AS t FROM b JOIN coded USING (x) GROUP BY 1),
    gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE
      * ((SELECT count(*) FROM d) + 10000)::DOUBLE / ((s + 1)::DOUBLE
      * ((SELECT count(*) FROM b) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
    weighed AS (SELECT doc_id, count(*) AS n_features, sum(gain) AS weight
      FROM d JOIN coded USING (x) JOIN gain USING (bucket) GROUP BY 1),
    scored AS (SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
      (coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
      FROM documents LEFT JOIN weighed USING (doc_id)),
    ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS able
      FROM scored WHERE n_features >= 20)
    SELECT scored.*, CASE WHEN rank <= 10 * able // 100 THEN rank END AS rank
    FROM scored LEFT JOIN ranked USING (doc_id)""",
}
