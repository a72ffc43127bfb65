"""Common table expressions of the oracle SQL, written for DuckDB's regex and list functions.

Fixed values: stop words, affixes, marks and coefficients stand here a second time, as text, so that the oracle does
not follow a mistake in ``fixed_values``.
"""

SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

AR_DOCUMENTS = """
ar_documents AS (
  SELECT doc_id, translate(
    replace(replace(replace(replace(replace(replace(replace(lower(text),
      ' the ', ' في '), ' of ', ' من '), ' and ', ' إلى '), ' is ', ' كان '), ' to ', ' على '),
      ' that ', ' الذي '), ' by ', ' العلمي '),
    'abcdefghijklmnopqrstuvwxyz,?;', 'اببدييغلنةأتمنوسـراسوّآخهى،؟؛') AS text
  FROM documents)"""

NORMALIZED = rf"""{AR_DOCUMENTS},
normalized AS (
  SELECT doc_id, text, trim(regexp_replace(translate(
    regexp_replace(text, '[\x{{064B}}-\x{{065F}}\x{{0670}}\x{{0640}}]+', '', 'g'),
    'إأآٱةى', 'ااااهي'), '[^\x{{0600}}-\x{{06FF}}]+', ' ', 'g')) AS normalized_text
  FROM ar_documents)"""

CONTENT = f"""{NORMALIZED},
content AS (
  SELECT *, list_filter(string_split(normalized_text, ' '), lambda w: length(w) > 1 AND w NOT IN (
    'في', 'من', 'إلى', 'على', 'عن', 'مع', 'هذا', 'هذه', 'ذلك', 'التي', 'الذي',
    'وقد', 'كما', 'إلا', 'أن', 'إن', 'كان', 'لا', 'ما', 'هو', 'هي', 'لم', 'لن',
    'قد', 'أو', 'حتى', 'أي', 'بين', 'له', 'لها', 'بما', 'عند', 'كل', 'بعد', 'قبل',
    'ثم', 'منذ', 'خلال', 'حول', 'نحو', 'غير', 'بل', 'لكن', 'وهو', 'وهي', 'فإن',
    'وأن', 'أما', 'إذا', 'كانت', 'وكان', 'أيضا', 'فقد', 'وفي', 'ومن', 'وعلى',
    'وإن', 'كذلك', 'ولا', 'ولم', 'وكانت', 'أنه', 'أنها', 'إنه', 'إنها')) AS words
  FROM normalized)"""

CLEAN = rf"""{CONTENT},
clean AS (
  SELECT *, list_transform(words, lambda w: regexp_replace(regexp_replace(w,
    '^(?:ال|وال|بال|كال|فال|لل|و|ف|ب|ك|ل|س)(.{{3,}})$', '\1'),
    '^(.{{3,}})(?:ها|هم|هن|كم|كن|نا|ون|ين|ان|ات|وا|ية)$', '\1')) AS stems
  FROM content)"""

CLEAN_WORDS = f"""{CLEAN},
clean_words AS (SELECT doc_id, unnest(stems) AS word FROM clean)"""

CLEAN_BIGRAMS = f"""{CLEAN},
clean_bigrams AS (
  SELECT doc_id, unnest(list_transform(range(1, len(stems)), lambda i: stems[i] || ' ' || stems[i + 1])) AS bigram
  FROM clean)"""

FEATURES = rf"""{AR_DOCUMENTS},
token_counts AS (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^{SPACE}]+')) AS word FROM ar_documents)
  GROUP BY doc_id, word),
ginis AS (
  SELECT doc_id, (2 * sum(i * n))::DOUBLE / (count(*) * sum(n))::DOUBLE
    - (count(*) + 1)::DOUBLE / count(*)::DOUBLE AS g
  FROM (SELECT doc_id, n, row_number() OVER (PARTITION BY doc_id ORDER BY n, word) AS i FROM token_counts)
  GROUP BY doc_id),
features AS (
  SELECT d.doc_id,
    coalesce(len(regexp_extract_all(text, '[٠-٩0-9]'))::DOUBLE / nullif(length(text), 0), 0) AS f3_digits_ratio,
    coalesce(len(list_filter(['،', '؛', '؟', '!', ':', '.', ',', '"', '''', '(', ')', '[', ']', '{{', '}}'],
      lambda m: contains(text, m)))::DOUBLE / nullif(length(text), 0), 0) AS f24_punct_div,
    len(regexp_extract_all(text, 'ال[\p{{L}}\p{{N}}_]+ي([^\p{{L}}\p{{N}}_]|$)'))::DOUBLE AS f45_adj_count,
    len(regexp_extract_all(regexp_replace(text, '([{SPACE}])', '\1\1', 'g'),
      '(^|[^\p{{L}}\p{{N}}_])(?:في|من|إلى|على|عن|مع)[{SPACE}]'))::DOUBLE AS f66_genitive_count,
    coalesce(g, 0) AS f87_gini
  FROM ar_documents d LEFT JOIN ginis USING (doc_id))"""

LABELLED_FEATURES = f"""{FEATURES},
labelled AS (SELECT f.*, l.quality AS label FROM features f JOIN labels l USING (doc_id))"""

SCORED = f"""{FEATURES},
scored AS (
  SELECT doc_id, l.quality AS label, margin, CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction
  FROM (SELECT doc_id, round(
      f3_digits_ratio * CAST(5.037039 AS DOUBLE) + f24_punct_div * CAST(-58.637206 AS DOUBLE)
      + f45_adj_count * CAST(-0.003263 AS DOUBLE) + f66_genitive_count * CAST(0.024537 AS DOUBLE)
      + f87_gini * CAST(1.110944 AS DOUBLE), 6) AS margin FROM features)
  JOIN labels l USING (doc_id))"""

CONFUSION = """
confusion AS (
  SELECT sum((label = 1 AND prediction = 1)::INT)::DOUBLE AS tp,
    sum((label = 0 AND prediction = 0)::INT)::DOUBLE AS tn,
    sum((label = 0 AND prediction = 1)::INT)::DOUBLE AS fp,
    sum((label = 1 AND prediction = 0)::INT)::DOUBLE AS fn,
    count(*)::DOUBLE AS n
  FROM scored)"""

BUCKET = "('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 100"
