"""Fixed values.

Word lists, lookup tables, patterns, formats, thresholds and message texts that
results depend on.  They are plain data: logic lives elsewhere.
"""

# --- fixed values: document types, folders, statuses -------------------------
INVOICE, RESUME, OTHER = "Invoice", "Resume", "Other"
DOCUMENT_TYPES = (INVOICE, RESUME, OTHER)
FOLDERS = {"Invoice": "invoices", "Resume": "resumes", "Other": "other"}
STORAGE_ROOT = "storage"

PROCESSED, NEEDS_REVIEW, FAILED = "Processed", "Needs Review", "Failed"
STATUSES = (PROCESSED, NEEDS_REVIEW, FAILED)

NOT_FOUND = "Not Found"
RULE_CLASSIFIER = "Rule-based"

# --- fixed values: limits ----------------------------------------------------
ALLOWED_EXTENSIONS = ("pdf", "jpg", "jpeg", "png")
MAX_UPLOAD_MB = 10
MAX_UPLOAD_BYTES = MAX_UPLOAD_MB * 1024 * 1024
MIN_USEFUL_CHARS = 15
TEXT_PREVIEW_CHARS = 1500
STEM_CHARS = 40
PAGE_SIZE = 20
INGEST_CONFIDENCE = 0.60
WORKFLOW_CONFIDENCE = 0.60

# First bytes of each accepted format, as hex.
MAGIC_BYTES = {
    "pdf": "25504446",
    "png": "89504E470D0A1A0A",
    "jpg": "FFD8FF",
    "jpeg": "FFD8FF",
}

# --- fixed values: keyword lists ---------------------------------------------
INVOICE_KEYWORDS = (
    "invoice", "invoice number", "invoice no", "total", "amount due",
    "bill to", "grand total", "tax invoice", "payment due",
)
RESUME_KEYWORDS = (
    "resume", "curriculum vitae", "cv", "skills", "education",
    "experience", "objective", "career summary",
)

# --- fixed values: extraction patterns ---------------------------------------
INVOICE_NUMBER_PATTERN = r"invoice\s*(?:number|no\.?|#)\s*[:\-]?\s*([A-Za-z0-9\-]+)"
BARE_NUMBER_PATTERN = r"#\s*([A-Za-z0-9\-]{4,})"
DATE_PATTERN = r"\b(\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}|\d{4}[/\-]\d{1,2}[/\-]\d{1,2})\b"
TOTAL_PATTERN = (
    r"(?:grand total|amount due|total amount|total)\s*[:\-]?\s*"
    r"([A-Za-z]{0,3}\s?[\$€£]?\s?[\d,]+\.?\d*)"
)
COMPANY_PATTERN = r"company(?:\s*name)?\s*[:\-]\s*(.+)"
EMAIL_PATTERN = r"[\w\.-]+@[\w\.-]+\.\w+"
PHONE_PATTERN = r"(\+?\d[\d\-\s\(\)]{7,}\d)"
SKILLS_PATTERN = r"skills\s*[:\-]?\s*(.+?)(?:education|experience|$)"
NAME_PATTERN = r"\bname\s*[:\-]\s*(.+)"
RESUME_TITLES = ("resume", "curriculum vitae", "cv")
COMPANY_CHARS, NAME_CHARS, SKILLS_CHARS, COMPANY_LINE_CHARS = 80, 60, 200, 60

# --- fixed values: extracted fields ------------------------------------------
INVOICE_FIELDS = ("Invoice Number", "Date", "Company Name", "Total Amount")
RESUME_FIELDS = ("Name", "Email", "Phone", "Skills")
IMPORTANT_FIELDS = {
    "Invoice": ("Invoice Number", "Company Name", "Total Amount"),
    "Resume": ("Name", "Email"),
}
SEARCH_FIELDS = {
    "company": "Company Name",
    "invoice_number": "Invoice Number",
    "total_amount": "Total Amount",
}

# --- fixed values: field checks ----------------------------------------------
REQUIRED_FIELDS = {
    "invoice": ("invoice_number", "date", "company_name", "total_amount"),
    "resume": ("name", "email", "skills"),
}
FIELD_ALIASES = {
    "invoice no": "invoice_number",
    "invoice number": "invoice_number",
    "invoice_no": "invoice_number",
    "invoice_id": "invoice_number",
    "company": "company_name",
    "company name": "company_name",
    "vendor": "company_name",
    "total": "total_amount",
    "total amount": "total_amount",
    "amount": "total_amount",
    "full name": "name",
    "candidate_name": "name",
    "e-mail": "email",
    "email address": "email",
    "mobile": "phone",
    "phone number": "phone",
    "contact": "phone",
}
# What a Unicode-aware strip removes at both ends.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
VALID_EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
VALID_PHONE_PATTERN = r"^\+?[\d\s\-().]+$"
PHONE_DIGITS = (7, 15)

# Accepted date shapes (digit counts) with the Spark format that checks the day.
DATE_FORMATS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", "d-M-yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
    (r"^\d{1,2}\s+[A-Za-z]+\s+\d{4}$", "d MMM yyyy"),
    (r"^\d{1,2}\s+[A-Za-z]+\s+\d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]+\s+\d{1,2},\s+\d{4}$", "MMM d, yyyy"),
    (r"^[A-Za-z]+\s+\d{1,2},\s+\d{4}$", "MMMM d, yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d"),
)
YEAR_ZERO = r"(^|\D)0000(\D|$)"
INVALID_REASONS = {
    "email": "not a valid email address",
    "phone": "not a valid phone number",
    "date": "not a recognised date format",
    "total_amount": "not a positive numeric amount",
}

# --- fixed values: workflow states -------------------------------------------
NEW, PROCESSING = "New", "Processing"
APPROVED, REJECTED, COMPLETED = "Approved", "Rejected", "Completed"
STATES = (NEW, PROCESSING, NEEDS_REVIEW, APPROVED, REJECTED, COMPLETED)
TRANSITIONS = {
    NEW: (PROCESSING,),
    PROCESSING: (NEEDS_REVIEW, COMPLETED, NEW),
    NEEDS_REVIEW: (APPROVED, REJECTED),
    APPROVED: (COMPLETED,),
    REJECTED: (NEW,),
    COMPLETED: (),
}
SUPPORTED_TYPES = ("invoice", "resume")

# --- fixed values: workflow actions and notes --------------------------------
ACTION_STARTED, NOTE_STARTED = "processing_started", "Workflow started"
ACTION_REVIEW = "sent_to_review"
ACTION_COMPLETED, NOTE_PASSED = "auto_completed", "Passed all validation and workflow rules"
ACTION_BLOCKED = "transition_blocked"
ACTION_FAILED = "processing_failed"
# decision -> (action, new state, default note)
REVIEW_ACTIONS = {
    "approve": ("reviewer_approved", APPROVED, "Approved by reviewer"),
    "reject": ("reviewer_rejected", REJECTED, None),
    "complete": ("workflow_completed", COMPLETED, "Approved document completed"),
    "resubmit": ("resubmitted", NEW, "Rejected document resubmitted"),
}
REJECT_NEEDS_REASON = "A reason is required when rejecting a document"

# --- fixed values: messages --------------------------------------------------
MSG_UNSUPPORTED = "'%s' is not a supported file type. Upload a PDF, JPG or PNG file."
MSG_EMPTY = "'%s' is empty."
MSG_TOO_LARGE = "'%s' is %s MB. The upload limit is 10 MB."
MSG_BAD_MAGIC = "'%s' does not look like a real %s file. Check the file and try again."
MSG_DUPLICATE = "This file is already in the library as '%s'."
MSG_DUPLICATE_RACE = "This file is already in the library."
MSG_SAVED = {
    PROCESSED: "Saved and processed.",
    NEEDS_REVIEW: "Saved, but it needs a quick review.",
    FAILED: "Saved, but it could not be processed.",
}
MSG_NO_TEXT = "No readable text was found in this file."
MSG_NO_TEXT_HINT = "If it is a scan, try a clearer image."
MSG_UNREADABLE = "This file could not be read."
MSG_NOT_EXTRACTED = "Fields could not be extracted automatically."
MSG_ALL_FOUND = "All important fields were found."
MSG_UNSURE = "The classifier is only %d%% sure about the document type."
MSG_GONE = "That document no longer exists."
MSG_CHANGES_SAVED = "Changes saved. Status: %s."
MSG_DELETED = "Document deleted."
MSG_NO_FIELDS = "No readable text/fields extracted (unreadable or scanned document)"
MSG_UNKNOWN_TYPE = "Unsupported or unknown document type: '%s'"
MSG_LOW_CONFIDENCE = "Low classification confidence (%s < 0.60)"
MSG_MISSING = "Missing required fields: %s"
MSG_INVALID = "Invalid fields: %s"
MSG_POSSIBLE_DUPLICATE = "Possible duplicate document"
MSG_TRANSITION = "Invalid transition: %s -> %s"
MSG_DOC_NOT_FOUND = "Document %s not found"
MSG_DECISION = "Unknown decision: %s"
MSG_NOT_FOUND_IN_SCAN = "'%s' was listed but not found."
NOTE_NO_OCR = "OCR is not available, so scanned pages were skipped."
NOTE_OCR_FAILED = "OCR failed on at least one page."

# --- fixed values: trace labels ----------------------------------------------
STEP_VALIDATE, STEP_HASH, STEP_DUPLICATE = "Validate", "Hash", "Duplicate check"
STEP_READ, STEP_CLEAN, STEP_CLASSIFY, STEP_EXTRACT = "Read / OCR", "Clean", "Classify", "Extract"
STEP_READ_SCANNED = "Read / OCR (scanned)"
STEP_STORE_FILE, STEP_STORE_META = "Store file", "Store metadata"

# --- fixed values: table columns ---------------------------------------------
UPDATABLE_COLUMNS = (
    "company", "invoice_number", "total_amount", "status", "status_reason",
    "fields_json", "text_preview",
)
SEARCH_COLUMNS = (
    "original_filename", "stored_filename", "company",
    "invoice_number", "document_type", "text_preview",
)

# --- fixed values: model candidates, in order of preference ------------------
CANDIDATES = ("LogisticRegression", "LinearSVM", "NaiveBayes")
