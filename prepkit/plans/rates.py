"""The published smoking rates used to fill in whether somebody smokes."""

# Share of smokers by sex, and by age in the two sources.
SEX_RATES = {"male": 0.131, "female": 0.101}
AGE_RATES_COARSE = {
    "18–24 years": 0.053,
    "25–44 years": 0.126,
    "45–64 years": 0.149,
    "65 years and older": 0.083,
}
AGE_RATES_FINE = {
    "15-17": 0.016,
    "18-24": 0.073,
    "25-34": 0.109,
    "35-44": 0.109,
    "45-54": 0.138,
    "55-64": 0.149,
    "65-74": 0.087,
    "75+": 0.029,
}
