"""Closed-class words of five languages, used where a caller brings no stop list."""

# Articles, prepositions, conjunctions, pronouns and auxiliaries, lower case,
# elided forms without their apostrophe.
STOP_WORDS = {
    "english": "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which with you",
    "french": "au aux avec ce ces dans de des du elle en est et eux il je l la le les leur mais ne nous ou par pas pour qu que qui sa se son sur un une vous",
    "german": "aber als am an auch auf aus bei das dem den der des die ein eine er es für hat ich im in ist mit nicht sich sie und von war wie wir zu zum",
    "italian": "al alla che chi come con da dal dei del dell della di e gli ha ho i il in io l la le lo ma mi nel non per più se si sono su un una",
    "spanish": "al como con de del el ella en era es esta este ha la las le lo los más me mi no o para pero por que se sin su un una y ya yo",
}


def words_of(languages: tuple[str, ...] | list[str]) -> list[str]:
    """The distinct stop words of the languages, sorted."""
    return sorted({word for language in languages for word in STOP_WORDS[language].split()})
