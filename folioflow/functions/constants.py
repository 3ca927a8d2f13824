"""Fixed values that results depend on."""

# Classes in order of their ids.
CLASSES = ["NAME", "CONTACT", "SUMMARY", "EDUCATION", "EXPERIENCE", "SKILLS", "CERTIFICATION", "PROJECT", "ACHIEVEMENT", "LANGUAGE", "REFERENCE", "OTHER", "JOB_TITLE"]

# Section headings, folded, by label; order decides ties.
HEADINGS = {
    "SUMMARY": ["summary", "profile", "about me", "objective", "career objective", "professional summary", "gioi thieu", "gioi thieu ban than", "muc tieu", "muc tieu nghe nghiep", "tom tat", "ve toi"],
    "CONTACT": ["contact", "contact information", "personal information", "personal details", "thong tin lien he", "lien he", "thong tin ca nhan"],
    "EDUCATION": ["education", "academic background", "educational background", "hoc van", "trinh do hoc van", "qua trinh hoc tap"],
    "EXPERIENCE": ["experience", "work experience", "working experience", "employment history", "professional experience", "kinh nghiem", "kinh nghiem lam viec", "qua trinh lam viec", "qua trinh cong tac", "thuc tap", "internship", "internships"],
    "SKILLS": ["skills", "technical skills", "soft skills", "competencies", "ky nang", "chuyen mon", "ky nang chuyen mon", "ky nang mem"],
    "CERTIFICATION": ["certifications", "certificates", "licenses", "chung chi", "chung nhan"],
    "PROJECT": ["projects", "personal projects", "du an", "du an ca nhan"],
    "ACHIEVEMENT": ["achievements", "awards", "honors", "activities", "thanh tich", "thanh tuu", "giai thuong", "hoat dong"],
    "LANGUAGE": ["languages", "ngoai ngu", "ngon ngu"],
    "REFERENCE": ["references", "nguoi tham chieu", "nguoi gioi thieu", "tham khao"],
    "OTHER": ["hobbies", "interests", "so thich", "thong tin them", "additional information"],
}
# Folded prefixes of contact lines, words that join headings, thresholds.
CONTACT_PREFIXES = ["dia chi", "address", "ngay sinh", "date of birth", "dob", "gioi tinh", "gender", "email", "phone", "sdt", "so dien thoai", "dien thoai", "website", "facebook", "linkedin", "github", "zalo"]
CONNECTORS = ["va", "and", "cua", "toi", "my"]
HEADING_MAX_WORDS, HEADING_SIZE_MARGIN, HEADING_FUZZY_RATIO, COLUMN_MIN_GAP = 7, 0.5, 0.85, 0.25
JOB_TITLE_MAX_WORDS, SUMMARY_MIN_WORDS = 10, 5
# Characters of text cleaning.
BULLETS = "•●▪■□◦○‣⁃∙·➢➤►▶✓✔❖◆◇★☆*"
INVISIBLE = "​‌‍⁠﻿­"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
IMAGE_EXTENSIONS = ["png", "jpg", "jpeg", "bmp", "tif", "tiff", "webp"]
OFFICE_EXTENSIONS = ["docx", "doc", "odt", "rtf"]
# Field patterns in the order in which they take precedence.
FIELDS = {
    "EMAIL": r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+",
    "URL": r"(?:https?://|www\.)\S+|\b(?:linkedin\.com|github\.com|behance\.net)/\S+",
    "PHONE": r"(?<![\w.])(?:\+?84|0)(?:[ .-]?\d){8,10}(?!\d)",
    "DATE": r"(?i)(?:(?:tháng\s*)?\d{1,2}\s*(?:/|năm)\s*)?(?:19|20)\d{2}(?:\s*[-–—~]\s*(?:(?:tháng\s*)?\d{1,2}\s*(?:/|năm)\s*)?(?:(?:19|20)\d{2}|nay|hiện\s*(?:tại|nay)|present|now))?",
}
KEYWORDS = [(k, label) for label, ks in HEADINGS.items() for k in ks]
# The Markdown form of a result.
MARKDOWN_HEAD = "### %d. %s  _(trang %s, score %.2f, %s)_"
MARKDOWN_EMPTY = "_(không có chữ)_"
MARKDOWN_REST = "### ⚠️ Chữ không thuộc vùng nào"
MARKDOWN_PAGE = "_Trang %d:_  \n"
