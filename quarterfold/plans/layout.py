"""The printed report: line number, label and the figures of each line."""

from __future__ import annotations

# Fixed values: (line, label, figure of the period, cumulative figure).
LINES: tuple[tuple[int | None, str, str | None, str], ...] = (
    (6, "Total registered", "new_total_reg", "cum_total_reg"),
    (7, "FT: Patients initiated on ART first time", "new_ft", "cum_ft"),
    (8, "Re: Patients re-initiated on ART", "new_re", "cum_re"),
    (9, "TI: Patients transfered in on ART", "new_ti", "cum_ti"),
    (10, "Males (all ages)", "new_males", "cum_males"),
    (11, "Non-pregnant Females (all ages)", "new_non_preg", "cum_non_preg"),
    (12, "Pregnant Females (all ages)", "new_preg_all_age", "cum_preg_all_age"),
    (13, "A: Infants (0<24 months at ART initiation)", "new_a", "cum_a"),
    (14, "B: Children (24 mths -14 yrs at ART initiation)", "new_b", "cum_b"),
    (15, "C: Adults (15 years or older at ART initiation)", "new_c", "cum_c"),
    (None, "Unknown age", "new_unk_age", "cum_unk_age"),
    (16, "Presumed severe HIV disease in infants", "new_pres_hiv", "cum_pres_hiv"),
    (17, "Confirmed HIV infection in infants (PCR)", "new_conf_hiv", "cum_conf_hiv"),
    (18, "WHO stage 1 or 2, CD4 below threshold", "new_who_1_2", "cum_who_1_2"),
    (19, "WHO stage 2, total lymphocytes <1,200/mm3", "new_who_2", "cum_who_2"),
    (52, "Children 12-23 mths", "new_children", "cum_children"),
    (53, "Breastfeeding mothers", "new_breastfeed", "cum_breastfeed"),
    (54, "Pregnant women", "new_preg", "cum_preg"),
    (20, "WHO stage 3", "new_who_3", "cum_who_3"),
    (21, "WHO stage 4", "new_who_4", "cum_who_4"),
    (22, "Unknown/other reason outside guidelines", "new_other_reason", "cum_other_reason"),
    (23, "No TB", "new_no_tb", "cum_no_tb"),
    (24, "TB within the last 2 years", "new_tb_w2yrs", "cum_tb_w2yrs"),
    (25, "Current episode of TB", "new_current_tb", "cum_current_tb"),
    (26, "Kaposis Sarcoma", "new_ks", "cum_ks"),
    (27, "Total alive and on ART", None, "total_on_art"),
    (28, "Died within the 1st month after ART initiation", None, "died_1st_month"),
    (29, "Died within the 2nd month after ART initiation", None, "died_2nd_month"),
    (30, "Died within the 3rd month after ART initiation", None, "died_3rd_month"),
    (31, "Died after the end of the 3rd month after ART initiation", None, "died_after_3rd_month"),
    (32, "Died total", None, "died_total"),
    (33, "Defaulted (more than 2 months overdue after expected to have run out of ARVs)", None, "defaulted"),
    (34, "Stopped taking ARVs (clinician or patient own decision, last known alive)", None, "stopped"),
    (35, "Transfered out", None, "transfered"),
    (None, "Unknown outcome", None, "unknown_outcome"),
    (38, "1A (D4T+3TC+NVP)", None, "n1a"),
    (None, "1P (D4T+3TC+NVP)", None, "n1p"),
    (38, "2A (AZT+3TC+NVP)", None, "n2a"),
    (None, "2P (AZT+3TC+NVP)", None, "n2p"),
    (38, "3A (D4T+3TC+EFV)", None, "n3a"),
    (None, "3P (D4T+3TC+EFV)", None, "n3p"),
    (38, "4A (AZT+3TC+EFV)", None, "n4a"),
    (None, "4P (AZT+3TC+EFV)", None, "n4p"),
    (38, "5A (TDF+3TC+EFV)", None, "n5a"),
    (38, "6A (TDF+3TC+NVP)", None, "n6a"),
    (38, "7A (TDF+3TC+LPV/r)", None, "n7a"),
    (38, "8A (AZT+3TC+LPV/r)", None, "n8a"),
    (38, "9P (ABC+3TC+LPV/r)", None, "n9p"),
    (44, "Non-standard", None, "non_std"),
    (45, "Total patients with side effects", None, "side_effects"),
    (46, "Patients with 0-6 doses missed at their last visit(before end of quarter evaluated)", None, "missed_0_6"),
    (47, "Patients with 7+ doses missed at their last visit(before end of quarter evaluated)", None, "missed_7plus"),
    (48, "TB not suspected", None, "tb_no_suspect"),
    (49, "TB suspected", None, "tb_suspected"),
    (50, "TB confirmed, not yet/currently not on TB treatment", None, "tb_confirm_not_treat"),
    (51, "TB confirmed, on TB treatment", None, "tb_confirmed"),
    (None, "Unknown TB status", None, "unknown_tb"),
)


def cells() -> list[tuple[str, int, int | None, str, str]]:
    """``(indicator, position, line, label, figure)`` of every figure on the report."""
    out = []
    for position, (line, label, new, cumulative) in enumerate(LINES, start=1):
        if new:
            out.append((new, position, line, label, "quarter"))
        out.append((cumulative, position, line, label, "cumulative"))
    return out
