"""Output labels and text patterns the monthly reports use.

These strings are part of the result contract (downstream reports filter on
them), so they must stay exactly as written here, typos included. They are
kept together and in their natural order.
"""

# --- fixed values: tenure bands, product mixes, technology -------------------
EARLY, MID, LATE = "Early-Tenure", "Mid-Tenure", "Late-Tenure"
TENURES = (EARLY, MID, LATE)
MIX_NAMES = {  # (broadband, tv, voice) -> mix name
    (1, 0, 0): "BB", (0, 1, 0): "TV", (0, 0, 1): "VO", (1, 1, 0): "BB+TV",
    (1, 0, 1): "BB+VO", (0, 1, 1): "VO+TV", (1, 1, 1): "BB+VO+TV",
}
TECH_BY_DROP = {"FIBER": "FTTH", "FIBCO": "FIBCO", "COAX": "HFC"}
FIXED_FMC_HINT = ("1.Real FMC", "2.Near FMC", "3.Fixed Only")

# --- fixed values: movements and spins ---------------------------------------
SAME, UPSELL, DOWNSELL = "1.SameRGUs", "2.Upsell", "3.Downsell"
NEW_CUSTOMER, COME_BACK = "4.New Customer", "5.Come Back to Life"
NULL_LAST_DAY, ALWAYS_NULL, GROSS_ADD_GAP = "6.Null last day", "7.Always null", "8.Rejoiner-GrossAdd Gap"
TRANSFER_ADDS = "7.Transfer Adds"
FIXED_SPIN = ("1. Up-spin", "2. Down-spin", "3. No Spin")
MOBILE_SPIN = ("1.Same", "2.Upspin", "3.Downspin", "4.NoSpin")

# --- fixed values: fixed churn ------------------------------------------------
DX_MIGRATION_REASON, DX_NONPAY_REASON = "MIG COAX TO FIB", "NON-PAY"
DX_MIGRATION, DX_INVOLUNTARY, DX_VOLUNTARY = "Migracion", "Involuntario", "Voluntario"
FIX_VOLUNTARY, FIX_INVOLUNTARY = "1. Fixed Voluntary Churner", "2. Fixed Involuntary Churner"
FIX_TRANSFER, FIX_0P = "3. Fixed Transfer", "4. Fixed 0P Churner"
# the converged labels look for another spelling of it, which never occurs
FIX_0P_EXPECTED = "3. Fixed 0P Churner"
FIX_CHURNER, FIX_NONCHURNER = "1. Fixed Churner", "2. Fixed NonChurner"
CHURNER_GAP, CHURNER_0P = "Churner Gap", "Churner0P"
FIX_FINAL = ("Transfer", "Early Dx", "Incomplete CST", "Voluntary", "Involuntary", "0P Churner")
PLAY_NONE = "0P"
RELOCATION = "RELOCATION/TRAN"
DISCONNECT = "V_DISCO"

# --- fixed values: mobile churn -------------------------------------------------
MOB_CHURNER, MOB_NONCHURNER = "1. Mobile Churner", "2. Mobile NonChurner"
MOB_VOLUNTARY, MOB_INVOLUNTARY = "1. Mobile Voluntary Churner", "2. Mobile Involuntary Churner"
POSTPAID = "Postpaid"
# cancellation reasons that are not real churn (the subscriber is put back)
INVALID_REASON_PATTERNS = ("%contract%accepted%", "%portin%", "%ctn%activation%", "%per%cust%req%",
                           "%reduced%rate%suspend%", '%""%')
INVALID_SUSPENSION_PATTERNS = ('%""%',)
# cancellation reasons that make a churn involuntary
INVOLUNTARY_REASON_PATTERNS = ("%no%pay%", "%no%use%", "%fraud%", "%off%net%", "%pay%def%",
                               "%lost%equip%", "%tele%conv%", "%cont%acce%req%", "%proce%")
INVOLUNTARY_SUSPENSION_PATTERNS = ("%no%pay%", "%no%use%", "%fraud%", "%off%net%", "%pay%def%",
                                   "%lost%equip%", "%tele%conv%", "%proce%")

# --- fixed values: converged base ---------------------------------------------
FMC_TYPES = ("Prepaid Real FMC", "Prepaid Near FMC", "Fixed Only", "Mobile Only", "Real FMC", "Near FMC",
             "Postpaid Real FMC", "Postpaid Near FMC")
WIRELESS = "WIRELESS"
MOBILE_SEGMENT = "P1 Mobile"
REJOINER_LABELS = ("1. Full Rejoiner", "2. Fixed Rejoiner", "3. Mobile Rejoiner", "1. FMC Rejoiner")
FINAL_CHURN = ("Churner", "Fixed Churner", "Mobile Churner", "Non Churner")
CHURN_TYPES = ("Voluntary Churner", "Involuntary Churner", "Mixed Churner", "0P Churner", "Fixed Transfer",
               "Non Churner")
PARTIAL_CHURN = ("Total Churner", "Partial Churner")
FMC_SEGMENTS_REJOIN = ("2P FMC", "3P FMC", "4P FMC")
WATERFALL = ("Gross Adds", "GrossAdds-Fixed Customer Gap", "ComeBackToLife-Fixed Customer Gap",
             "5.1. FMC Rejoiner", "5.2. Fixed Rejoiner", "5.3. Mobile Rejoiner", "5.4 Near Rejoiner",
             "Fixed Transfer Adds", "Fixed Transfer Churn", "Upsell", "Downsell", "Maintain", "Upspin",
             "Downspin", "Voluntary Churner", "Involuntary Churner", "Mixed Churner", "Loss-Fixed Customer Gap")

# --- fixed values: sales drivers ------------------------------------------------
TECH_CALL_INCLUDE = (
    "%ppv%problem%", "%hsd%problem%", "%cable%problem%", "%tv%problem%", "%video%problem%",
    "%tel%problem%", "%phone%problem%", "%int%problem%", "%line%problem%", "%hsd%issue%",
    "%ppv%issue%", "%video%issue%", "%tel%issue%", "%phone%issue%", "%int%issue%", "%line%issue%",
    "%cable%issue%", "%tv%issue%", "%bloq%", "%slow%", "%slow%service%", "%service%tech%",
    "%tech%service%", "%no%service%", "%hsd%no%", "%hsd%slow%", "%hsd%intermit%", "%no%brows%",
    "%phone%cant%", "%phone%no%", "%no%connect%", "%no%conect%", "%no%start%", "%equip%",
    "%intermit%", "%no%dat%", "%dat%serv%", "%int%data%", "%tech%", "%supp%", "%outage%", "%mass%",
    "%discon%warn%")
TECH_CALL_EXCLUDE = (
    "%work%order%status%", "%default%call%wrapup%", "%bound%call%", "%cust%first%", "%audit%",
    "%eq%code%", "%downg%", "%upg%", "%vol%discon%", "%discon%serv%", "%serv%call%")
DROPPED_PURPOSES = ("Work Order Status", "Default Call Wrapup", "G:outbound Calls", "Eq: Cust. First",
                    "Eq: Audit", "Eq: Code Error", "Downgrade Service", "Disconnect Service",
                    "Rt: Dowgrde Service", "Cust Service Calls")
TRUCKROLL, TECH_CALL = "truckroll", "tech_call"
SALES_EXCLUDED_WATERFALL = ("Downsell-Fixed Customer Gap", "Fixed Base Exception", "Churn Exception")
INSTALL_COMMAND = "CONNECT"
