"""Declared schemas (DDL) of the tables between stages; every reader takes them as they are."""

MAIL_PART = "message_id string, message_ord bigint, subject string, `from` string, email_datetime string, gmail_query string, part_ord int, text string"
URL_QUEUE = "url string, source_message_id string, source_subject string, email_datetime string, gmail_query string, status string"
URL_QUEUE_NORMALIZED = "original_url string, normalized_url string, source_message_id string, source_subject string, email_datetime string, gmail_query string, status string, normalization_notes array<string>"
CLASSIFIED = "original_url string, normalized_url string, platform string, source_message_id string, source_subject string, email_datetime string, gmail_query string, status string, filter_reason string, normalization_notes array<string>"
SCRAPE_LOG = "normalized_url string, content_type string, status string, error string, slide_count int, slide_paths array<string>, html_path string, processed_at timestamp, cookie_action string, login_action string, navigation_actions array<string>"
OCR_RAW = "post_id string, content_type string, slide_filename string, slide_index int, slide_total int, source_image string, ocr_region string, ocr_text_raw string, ocr_status string, error string, processed_at timestamp, event string, timestamp string"
PROMPT = "struct<prompt_carrousel_page_num:int,prompt_title:string,prompt_date:string,prompt_text_raw:string,prompt_text_clean:string,prompt_type:string,target_engine:array<string>,output_modality:array<string>,comments:array<string>,extraction_confidence:string,extraction_confidence_score:int>"
SEMANTIC = f"post_id string, prompt_social_media string, content_type string, carrousel_title string, prompt_count_detected int, prompts array<{PROMPT}>, semantic_producer string, semantic_extracted_at timestamp"
PROMPTS = "prompt_unique_id string, prompt_text_original string, prompt_text_clean string, prompt_type string, target_engine array<string>, output_modality array<string>, prompt_title string, prompt_date string, prompt_social_media string, prompt_carrousel_id string, prompt_carrousel_page_num int, carousel_title string, comments array<string>, extraction_confidence string, prompt_size_chars int, record_status string, model string"
