"""Fixed values. Results depend on them, so they are stated here, together and as they are."""

# Page footer: two line breaks, six tabs, eleven hashes on either side of the number, two line breaks.
FOOTER_BEFORE = "\n\n\t\t\t\t\t\t########### "
FOOTER_AFTER = " ###########\n\n"

# Document that wraps hOCR page fragments.
HOCR_HEADER = (
    '<!DOCTYPE html PUBLIC "-//W3C//DTD HTML 4.01 Transitional//EN" "http://www.w3.org/TR/html4/loose.dtd">\n'
    "<html>\n<head>\n<title></title>\n"
    '<meta http-equiv="Content-Type" content="text/html;charset=utf-8" />\n'
    "<meta name='ocr-system' content='tesseract'/>\n</head>\n<body>\n"
)
HOCR_FOOTER = "</body>\n</html>\n"

# Index records.
INDEX_FIELDS = ("filename", "classification", "date", "content")
PREVIEW_CHARS = 300

# Scanning, page batches, extraction, classification.
SOURCE_EXTENSION = "pdf"
TEXT_EXTENSION = "txt"
MAX_PAGES = 50
LANGUAGE = "spa"
SEPARATOR_VARIABLE = "SEPARATOR"
SEPARATOR = ","

# Image cleaning.
THRESHOLD = 100
WHITE = 255
NOISE_KERNEL = 3
GROW_KERNEL = 100
SHRINK_KERNEL = 50
