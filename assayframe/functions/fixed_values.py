"""Fixed values.

Everything in this file is data that decides results: word lists, patterns, ranges,
codes, names and message formats. They are plain values in their natural order and
hold no logic. Every operator takes them as default arguments, so a caller can
replace any of them.
"""

# --- fixed values: record validation -------------------------------------------------

REQUIRED_FIELDS = [
    "mrn", "patient_name", "age", "gender", "admission_date", "discharge_date", "diagnoses",
]
GENDERS = ["M", "F", "O", "U", ""]
AGE_RANGE = (0, 120)
ICD10_RECORD_PATTERN = r"^[A-Z]\d{2}(\.\d{1,4})?$"
ICD10_RULE_PATTERN = r"^[A-Z]\d{2}(\.\d{1,2})?$"
DOSE_PATTERN = r"^\d+(\.\d+)?\s*(mg|mcg|ml|units?|g)$"

# drug_a, drug_b, severity, description
DRUG_INTERACTIONS = [
    ("Warfarin", "Aspirin", "HIGH",
     "Increased bleeding risk with concurrent anticoagulant and antiplatelet therapy"),
    ("Lisinopril", "Furosemide", "MODERATE",
     "ACE inhibitor + loop diuretic may cause excessive hypotension"),
    ("Metformin", "Furosemide", "LOW",
     "Loop diuretics may increase blood glucose, reducing metformin efficacy"),
]

# vital, min, max, critical_low, critical_high
VITAL_RANGES = [
    ("systolic_bp", 60, 250, 70, 200),
    ("diastolic_bp", 30, 150, 40, 120),
    ("heart_rate", 30, 220, 40, 180),
    ("temperature_f", 90, 108, 95, 104),
    ("respiratory_rate", 6, 60, 8, 40),
    ("oxygen_saturation", 50, 100, 88, 100),
]

ICD10_DESCRIPTIONS = [
    ("E11.9", "Type 2 diabetes mellitus without complications"),
    ("I10", "Essential (primary) hypertension"),
    ("J44.1", "Chronic obstructive pulmonary disease with acute exacerbation"),
    ("I25.10", "Atherosclerotic heart disease of native coronary artery"),
    ("N18.3", "Chronic kidney disease, stage 3"),
    ("J18.9", "Pneumonia, unspecified organism"),
    ("I50.9", "Heart failure, unspecified"),
    ("K21.0", "Gastro-esophageal reflux disease with esophagitis"),
    ("M54.5", "Low back pain"),
    ("F32.1", "Major depressive disorder, single episode, moderate"),
]
INVALID_CODES = ["ZZ99.9", "X00", "ABC.1", "999.99", ""]

# --- fixed values: text gates --------------------------------------------------------

PROFANITY_PATTERN = (
    r"\b(damn|shit|fuck|bitch|bastard|asshole|crap|retard(?:ed)?|idiot|moron|"
    r"stupid\s+patient|junkie|addict\s+scum|druggie|drunk(?:ard)?)\b"
)
SSN_PATTERN = r"\b\d{3}-\d{2}-\d{4}\b"
EMAIL_PATTERN = r"[\w.+-]+@[\w-]+\.[\w.-]+"
PHONE_PATTERN = r"\b(?:\+?1[-.\s]?)?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}\b"
ADDRESS_PATTERN = (
    r"\b\d{1,5}\s+(?:[A-Z][a-z]+\s+){1,3}"
    r"(?:St(?:reet)?|Ave(?:nue)?|Blvd|Dr(?:ive)?|Rd|Ln|Ct|Way|Pl)\b"
)
TERM_PATTERN = (
    r"\b(diagnosis|prognosis|treatment|therapy|medication|prescription|dosage|"
    r"symptom|sign|assessment|plan|follow[- ]?up|discharge|admission|"
    r"vital|blood\s+pressure|heart\s+rate|temperature|respiratory|"
    r"oxygen|saturation|CBC|BMP|CMP|CT|MRI|X-ray|ultrasound|"
    r"surgery|procedure|biopsy|pathology|lab|culture|"
    r"hypertension|diabetes|pneumonia|fracture|infection|"
    r"antibiotic|analgesic|insulin|metformin|aspirin|warfarin|"
    r"patient|chief\s+complaint|history|physical\s+exam|"
    r"mg|mcg|ml|BID|QD|TID|QHS|PRN)\b"
)
BIAS_PATTERN = (
    r"\b(non-?compliant\s+(?:elderly|older|young)|drug[- ]?seeking\s+behavio(?:u)?r|"
    r"frequent\s+flyer|poor\s+historian|(?:un)?reliable\s+(?:historian|reporter)|"
    r"difficult\s+patient|(?:male|female)\s+(?:hysteri(?:a|cal))|"
    r"(?:she|he)\s+(?:claims|alleges)\s+(?:pain|symptoms)|"
    r"(?:elderly|geriatric)\s+(?:and\s+)?(?:confused|demented)|"
    r"(?:obese|overweight)\s+(?:and\s+)?(?:non-?compliant|lazy))\b"
)
SECTION_PATTERN = (
    r"\b(Assessment|Plan|Subjective|Objective|Chief\s+Complaint|History|Physical\s+Exam|"
    r"Hospital\s+Course|Discharge\s+(?:Summary|Instructions)|Follow[- ]?up|Medications|"
    r"Diagnos[ei]s)[\s:—]"
)
MIN_WORDS = 20
STRUCTURE_WORDS = 40
MIN_ALPHA_RATIO = 0.60

# gate counter, issue type
GATE_COUNTERS = [
    ("profanity_detected", "RA_PROFANITY"),
    ("phi_exposure_risk", "RA_PHI_EXPOSURE"),
    ("low_relevance", "RA_LOW_RELEVANCE"),
    ("bias_indicators", "RA_BIAS_INDICATOR"),
    ("low_coherence", "RA_LOW_COHERENCE"),
    ("garbled_text", "RA_GARBLED_TEXT"),
    ("unstructured_notes", "RA_UNSTRUCTURED_NOTE"),
    ("empty_notes", "RA_EMPTY_NOTE"),
]

# --- fixed values: entities ----------------------------------------------------------

MEDICATION_KEYWORDS = [
    "Metformin", "Lisinopril", "Atorvastatin", "Omeprazole", "Amlodipine",
    "Albuterol", "Sertraline", "Aspirin", "Furosemide", "Warfarin",
]
# keyword, normalized name
CONDITION_KEYWORDS = [
    ("diabetes", "Type 2 diabetes mellitus"),
    ("hypertension", "Essential hypertension"),
    ("pneumonia", "Pneumonia"),
    ("heart failure", "Heart failure"),
    ("copd", "Chronic obstructive pulmonary disease"),
    ("chest pain", "Chest pain"),
    ("shortness of breath", "Dyspnea"),
    ("back pain", "Low back pain"),
]
DATE_ENTITY_PATTERN = r"\d{4}-\d{2}-\d{2}"
MEDICATION_SCORE = 0.95
CONDITION_SCORE = 0.92
DIAGNOSIS_TRAIT_SCORE = 0.88
DATE_SCORE = 0.99

# --- fixed values: request payloads --------------------------------------------------

MODEL_ID = "anthropic.claude-3-sonnet-20240229-v1:0"
API_VERSION = "bedrock-2023-05-31"
CONTENT_TYPE = "application/json"
SYSTEM_PROMPT = """You are a clinical decision support assistant for healthcare professionals. 
Your role is to analyze patient records and provide evidence-based clinical summaries.

Guidelines:
- Use standard medical terminology
- Reference ICD-10 codes when applicable
- Flag potential drug interactions or contraindications
- Provide structured output with clear sections
- Never provide definitive diagnoses — always frame as "clinical considerations"
- Include relevant vital sign trends in your analysis

Output Format:
1. Patient Summary
2. Active Problems List
3. Medication Review & Interaction Alerts
4. Clinical Considerations
5. Recommended Follow-up Actions"""
PROMPT_TITLE = "Patient Record Analysis Request\n================================"
PROMPT_CLOSING = (
    "Please provide a comprehensive clinical summary with medication review "
    "and follow-up recommendations."
)
NO_NOTE = "No clinical note available."
NO_VITALS = "Not recorded"

# --- fixed values: rule sets ---------------------------------------------------------

NOTE_TYPES = ["Discharge Summary", "Progress Note", "H&P"]
NOTE_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
MRN_PATTERN = r"^MRN-\d{6}$"
AUTHOR_PATTERN = r"^Dr\. [A-Z][a-z]+$"

# --- fixed values: metrics -----------------------------------------------------------

METRIC_BATCH = 20
PERIOD_SECONDS = 300
SCORE_METRIC = "GlueDQ_OverallScore"
RULES_PASSED_METRIC = "GlueDQ_RulesPassed"
RULES_FAILED_METRIC = "GlueDQ_RulesFailed"
RECORDS_METRIC = "GlueDQ_TotalRecords"
PASS_RATE_METRIC = "Validation_PassRate"
ERRORS_METRIC = "Validation_ErrorCount"
WARNINGS_METRIC = "Validation_WarningCount"
QUALITY_METRIC = "Validation_QualityScore"
BY_TYPE_METRIC = "Validation_ErrorsByType"
PROFANITY_METRIC = "Validation_ProfanityDetected"
PHI_METRIC = "Validation_PHIExposureRisk"
RELEVANCE_METRIC = "Validation_ClinicalRelevanceScore"
VALIDATOR_DIMENSION = {"Validator": "clinical-validator"}
RUN_DIMENSION = {"Pipeline": "healthcare-ingest"}
# alarm, metric, dimensions, statistic, comparison, threshold, periods, missing data
ALARMS = [
    ("Healthcare-DQ-OverallScore-Low", "GlueDQ_OverallScore", {"Dataset": "patient_records"},
     "Average", "<", 80.0, 2, "breaching"),
    ("Healthcare-Validation-HighErrorRate", "Validation_ErrorCount",
     {"Validator": "clinical-validator"}, "Sum", ">", 20.0, 1, "notBreaching"),
    ("Healthcare-DrugInteraction-Alert", "Validation_ErrorsByType",
     {"ErrorType": "DRUG_INTERACTION", "Validator": "clinical-validator"},
     "Sum", ">", 5.0, 1, "notBreaching"),
]
SERIES_ISSUE_TYPES = [
    "INVALID_ICD10", "VITAL_OUT_OF_RANGE", "DRUG_INTERACTION", "MISSING_REQUIRED_FIELD",
]
