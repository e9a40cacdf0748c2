"""Explicit schemas of the persisted tables, as DDL."""

ARTICLES = (
    "id string, slug string, title string, category_id int, category_name string, "
    "category_slug string, source_url string, content string, content_html string, "
    "word_count int, file_path string, article_order int, is_stub boolean, "
    "created_at timestamp, updated_at timestamp"
)

BIBLE_VERSES = (
    "id string, book string, chapter int, verse_start int, verse_end int, "
    "reference string, testament string"
)

QURAN_VERSES = (
    "id string, surah int, ayah_start int, ayah_end int, reference string, surah_name string"
)

ARTICLE_VERSES = "article_id string, verse_id string, occurrence_count int"

ARTICLE_CHUNKS = (
    "article_id string, chunk_index int, content string, token_count int, embedding array<float>"
)

CATEGORIES = (
    "id int, slug string, name string, description string, article_count int, source string"
)

VIDEOS = (
    "title string, video_url string, description string, upload_date string, duration double, "
    "thumbnail_url string, view_count bigint, transcript string, has_transcript boolean, "
    "matched_keywords array<string>, is_related boolean, scraped_at string"
)

VIDEO_INFO = (
    "id string, title string, url string, description string, upload_date string, "
    "duration double, thumbnail string, view_count bigint, "
    "subtitles map<string, array<struct<ext: string, url: string>>>, "
    "automatic_captions map<string, array<struct<ext: string, url: string>>>"
)

BLOG_STATE = "scraped_urls array<string>, last_run string"

INDEX_LINKS = (
    "folder string, position int, title string, url string, original_href string"
)

FILES = "path string, folder string, filename string, raw string"

CHECKS = (
    "section string, check_id string, status string, value bigint, expected bigint, detail string"
)
