"""Fixed code lists of the student information system."""

# homeless-program service flags (fixed column names of the SIS table)
HOMELESS_SERVICE_FLAGS = (
    "transportation", "tutor_instrsvcs", "school_supplies", "clothing", "counseling", "health_referrals",
    "records_transfer", "before_after_schl_pgm", "emer_assist_attendance", "parent_education", "staff_prof_dev",
    "other_svcs", "refer_other_pgmsvc", "assist_participation", "coord_schl_agency", "requestsnoservices",
)
