"""Building blocks of the SQL twins: the shared tables as common table expressions."""

from __future__ import annotations

from lakemill.functions.fixed import SPAM_KEYWORDS

# Query-level parameters shared by both sides.
#: Rows of a period at least, and periods at most: a century of months, so large tables get larger periods.
LEAST_ROWS, PERIODS = 100, 1200
#: The library's own list, and words that the given texts hold.
KEYWORDS = [*SPAM_KEYWORDS, "that", "with", "this", "from", "than", "that the"]


def period_rows(n: int) -> int:
    return max(LEAST_ROWS, -(-n // PERIODS))

UNICODE_SPACE = (
    r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def even(value: str, digits: int) -> str:
    """Round half to even at `digits` decimals."""
    scale = f"1e{digits}"
    return f"(round_even((({value}) * {scale})::DOUBLE, 0)::DOUBLE / {scale})"


def squeeze(text: str, keep: int) -> str:
    """Runs of three or more become `keep`, without back-references."""
    same = "c = ch[i-1]" if keep == 1 else "c = ch[i-1] AND c = ch[i-2]"
    if keep == 2:
        return (
            f"array_to_string(list_filter({text}, lambda c, i: NOT (i > 2 AND c = ch[i-1] AND c = ch[i-2])), '')"
        )
    # keep == 1: drop a character that repeats its predecessor inside a run of three or more.
    run = (
        "(ch[i+1] IS NOT DISTINCT FROM c AND i < len(ch))"
        " OR (i > 2 AND c = ch[i-2])"
    )
    return f"array_to_string(list_filter({text}, lambda c, i: NOT (i > 1 AND {same} AND ({run}))), '')"


def md5_int(key: str, seed: int, start: int) -> str:
    return f"('0x' || substr(md5({key} || '|{seed}'), {start}, 8))::BIGINT"


PARTS: dict[str, tuple[list[str], str]] = {}


RECURSIVE: set[str] = set()


def part(name: str, needs: list[str], body: str, recursive: bool = False) -> None:
    PARTS[name] = (needs, body)
    if recursive:
        RECURSIVE.add(name)


def twin(needs: list[str], body: str) -> str:
    """WITH the named parts and what they need, in order, then `body`."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in PARTS[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    ctes = ",\n".join(f"{n} AS (\n{PARTS[n][1]}\n)" for n in ordered)
    return f"WITH {'RECURSIVE ' * bool(RECURSIVE.intersection(ordered))}{ctes}\n{body}"


part("mails", [], """
SELECT d.doc_id, d.text AS body, CASE l.quality WHEN 0 THEN 'spam' WHEN 1 THEN 'ham' END AS raw_label
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")

part("chunked", ["mails"], f"""
SELECT doc_id, body, raw_label, idx, total, per,
  least(idx // per, CASE WHEN total % per = 0 OR (total % per < per // 2 AND total >= per) THEN total // per - 1 ELSE total // per END) AS chunk
FROM (SELECT *, greatest({LEAST_ROWS}, (total + {PERIODS - 1}) // {PERIODS}) AS per
  FROM (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS total FROM mails))""")

part("months", ["chunked"], f"""
SELECT *, strftime(DATE '2024-11-01' + to_months(chunk::INTEGER), '%Y-%m') AS month_partition,
  idx - chunk * per AS row_in_month
FROM chunked""")

part("ids", ["months"], """
SELECT *, printf('email_%s_%05d', replace(month_partition, '-', ''), row_in_month) AS email_id
FROM months""")

part("bronze", ["ids"], f"""
SELECT doc_id, email_id, body,
  CASE lower(trim(raw_label)) WHEN 'ham' THEN 0 WHEN 'spam' THEN 1 END AS label, raw_label,
  (month_partition || '-01')::TIMESTAMP
    + to_days(({md5_int('email_id', 42, 1)} % 28)::INTEGER)
    + to_hours({md5_int('email_id', 42, 9)} % 24)
    + to_minutes({md5_int('email_id', 42, 17)} % 60) AS received_at,
  month_partition
FROM ids""")


def clean_parts(prefix: str, source: str, needs: list[str], text: str = "body") -> None:
    """Cleaning steps of `source`.`text` as parts <prefix>_folded .. <prefix>_clean."""
    part(f"{prefix}_lined", needs, f"""
SELECT *, regexp_replace(lower(regexp_replace(strip_accents({text}), '[^\\x00-\\x7F]', '', 'g')),
  '[\\n\\r\\t]+', ' ', 'g') AS lined FROM {source}""")
    part(f"{prefix}_squeezed", [f"{prefix}_lined"], f"""
SELECT * EXCLUDE (ch), {squeeze('ch', 2)} AS squeezed
FROM (SELECT *, string_split(lined, '') AS ch FROM {prefix}_lined)""")
    part(f"{prefix}_clean", [f"{prefix}_squeezed"], f"""
SELECT * EXCLUDE (lined, squeezed), array_to_string(tokens, ' ') AS body_clean
FROM (SELECT *, list_filter(string_split_regex(
    regexp_replace(regexp_replace(squeezed, '\\b[a-z0-9]{{0,4}}escapenumber\\b', 'escapenumber', 'g'),
      '[^a-z0-9\\x09-\\x0D\\x1C-\\x20]', ' ', 'g'),
    '[\\x09-\\x0D\\x1C-\\x20]+'), lambda w: length(w) >= 3) AS tokens
  FROM {prefix}_squeezed)""")


clean_parts("bronze", "bronze", ["bronze"])

KEYWORD_PATTERN = "|".join(rf"\b{k}\b" for k in KEYWORDS)

part("featured", ["bronze_clean"], f"""
SELECT *, {even('unique_word_ratio * avg_word_length', 4)} AS complexity,
  {even('1 - unique_word_ratio', 4)} AS repetition_ratio
FROM (
  SELECT *, {even('char_count / greatest(word_count, 1)', 2)} AS avg_word_length,
    {even('ln(1 + char_count::DOUBLE)', 4)} AS log_chars, {even('ln(1 + word_count::DOUBLE)', 4)} AS log_words,
    {even('n_unique_words / greatest(word_count, 1)', 4)} AS unique_word_ratio,
    {even('n_unique_words / greatest(char_count, 1)', 6)} AS info_density
  FROM (
    SELECT *, length(body_clean)::INTEGER AS char_count, len(tokens)::INTEGER AS word_count,
      len(list_distinct(tokens))::INTEGER AS n_unique_words,
      len(regexp_extract_all(body, '!'))::INTEGER AS exclaim_count,
      len(regexp_extract_all(body, '\\?'))::INTEGER AS question_count,
      {even("len(regexp_extract_all(body, '[[:digit:]]')) / greatest(length(body), 1)", 4)} AS digit_ratio,
      {even("len(regexp_extract_all(body, '[A-Z]')) / greatest(length(body), 1)", 4)} AS upper_ratio,
      len(regexp_extract_all(body_clean, '{KEYWORD_PATTERN}'))::INTEGER AS spam_keyword_count,
      contains(lower(body), 'escapenumber')::INTEGER AS has_escapenumber
    FROM bronze_clean))""")

part("silver", ["featured"], """
SELECT doc_id, email_id, substr(body_clean, 1, 100000) AS body_clean, label, received_at,
  char_count, word_count, n_unique_words, avg_word_length, log_chars, log_words, unique_word_ratio,
  repetition_ratio, complexity, info_density, exclaim_count, question_count, digit_ratio, upper_ratio,
  spam_keyword_count, has_escapenumber, month_partition
FROM featured WHERE length(substr(body_clean, 1, 100000)) >= 50 AND label IS NOT NULL""")
