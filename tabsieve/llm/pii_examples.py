"""The small labelled table that the personal-data model learns from, and a part held out to measure it.

A label is written [kind text]; everything else is outside.  Sentences with data are made by a rule: every cue of a kind
comes with a number of forms of its values, among the words that may stand before and after.  The held-out part has
cues joined to other words, other forms and other names.  All names, numbers and addresses are invented.
"""

from __future__ import annotations

import random

# Words before a value, by kind; | parts them.
CUED = {
    "phone": "call|call us on|call me at|call me on|please call|phone|phone :|phone me on|tel .|tel :|Tel . :|tel|telephone|telephone :|my number is|our phone number is|my phone number is"
             "|reach me on|reach us at|mobile|mobile :|fax|fax :|ring|whatsapp|Telefon|Telefon :|Handy :|Handy|Rufnummer|rufen Sie an unter|erreichbar unter|Nummer|llame al|teléfono|teléfono :"
             "|Tfno .|móvil|móvil :|su número es|appelez le|téléphone :|tél .|Tél . :|portable :|mon numéro est|contact|contact us on",
    "id": "SSN|SSN :|ssn|her ssn is|his SSN was|social security number|social security number :|passport number|passport number is|her passport number is|passport no .|passport :|passport|IBAN|IBAN :"
          "|iban|account iban|pay to iban|Reisepass|Reisepass Nr .|Ausweis Nr .|Steuernummer|DNI|DNI :|su DNI es|pasaporte|pasaporte :|NIF|passeport|numéro de passeport|passeport no"
          "|license number|licence no .|tax number|insurance number|insurance no .",
    "email": "mail|mail me|email|email :|E - Mail :|e - mail|write to|please write to|contact|contact :|reach me at|you can reach me at|schreiben Sie an|Mail an|escriba a|correo :|écrivez à|or|:|my address is|send it to",
    "name": "Mr .|Mrs .|Ms .|Mr|Mrs|Miss|Dr .|Dr|Prof .|with Dr .|ask Mr .|Herr|Herrn|Frau|Herr Dr .|Sr .|Sra .|Señor|Señora|Don|Doña|el Sr .|M .|et M .|Mme|Mlle|Monsieur|Madame|my name is|her name is"
            "|name :|named|mein Name ist|ich heiße|Name :|me llamo|mi nombre es|nombre :|mon nom est|signed|signed ,|patient|patient :|customer :|Dear Mr .|Dear Ms .|Dear",
}
# Forms of values; 9 is a digit, X a capital letter.
FORMS = {
    "phone": "(999) 999-9999|999-999-9999|999 999 9999|999.999.9999|099 9999 9999|09999 999999|099/999999|099 9999999|09 99 99 99 99|99 999 99 99|999 99 99 99|0999-9999999|0999 999 9999|9999999999|099 999 99 99|0999 9999999|099 / 99999999|999 - 9999 - 999",
    "id": "999-99-9999|X9999999|XX999999|X99999999|99999999X|99999999-X|XX99 9999 9999 9999 9999 99|XX99 XXXX 9999 9999 9999 99|XX9999999999999999|XX 99 99 99 X|999999999|XX9999999|99999999999|99XX99999",
}
# Parts of names and of addresses written out.
FIRST = "Anna|John|Maria|Jean|Lena|Peter|Carlos|Sophie|Karl|Lucía|Emma|Paul|José|Claire|Hans|Elena|Q .|J .|Mary Ann|Jean - Luc".split("|")
LAST = "Smith|Berg|Lopez|Dupont|Vogt|van Dyk|García|Keller|Public|Martin|Müller|O ' Neill|Brown|Fernández|Lefèvre|Schmidt|de la Cruz|Moreau|Jones|Weber".split("|")
USERS = "john|anna . berg|info|k . olsen|maria|jean|team|lena dot vogt|jane dot doe|p _ weber|sales|c . moreau 77|contact".split("|")
AT, DOT = "( at )|[ at ]|at|at|at|AT".split("|"), "dot|( dot )|dot|[ dot ]|dot|.".split("|")
HOSTS = "example com|mail example org|shop example net|post no|correo es|site fr|firm de|web de|uni example edu".split("|")
BEFORE = "|please|and|or|you can|For details|und|oder|bitte|y|o|et|ou|Today|The office said|we said that|, thanks ,|."  .split("|")
AFTER = "|.|,|, please|today .|after six|or later|bitte|por favor|, merci|was given|and wait|will see you|is here .|has left|wohnt hier|vive aquí|est parti|( office )|, any time|in the morning|a écrit|waits there|va au marché|, danke".split("|")

# Sentences held out, for measuring only.
HELD_OUT = """
call us on [phone 020 7946 0958]
Tel : [phone 030 1234567]
Tel . [phone 089 / 55501234] ( Büro )
you may phone her at [phone 555 - 0142 - 889] in the morning
our office phone : [phone ( 617 ) 555 - 0188] .
mobile number [phone 07700 900123] , any time
ruf mich an , Handy [phone 0171 2345678]
Unser Telefon ist [phone 040 / 123456] .
mi móvil es [phone 612 34 56 78]
llame hoy al [phone 91 123 45 67] , por favor
mon téléphone est le [phone 06 12 34 56 78]
appelez vite le [phone 01 23 45 67 89] .
fax us : [phone 212 555 0199]
Her passport number is [id X1234567]
his passport no . [id AB123456] has expired
the SSN is [id 123 - 45 - 6789] , do not share
send money to IBAN [id DE44 5001 0517 5407 3249 31] today
IBAN : [id FR76 3000 6000 0112 3456 7890 189]
Meine Steuernummer : [id 98765432109]
mi DNI es [id 12345678Z] .
Mein Reisepass [id C01X00T47] ist weg
passeport : [id 12AB34567]
social security number is [id 987 - 65 - 4321]
tax number [id 555443333] was wrong
Dr . [name Brown] will call back
M . [name Dupont] est arrivé hier
ask Sr . [name García] about it
el señor Sr . [name Pérez] no vino
Mrs . [name Eleanor Rigby] waits there
my name is [name Tom Baker] and I like tea
mein Name ist [name Katrin Bauer] .
me llamo [name Pablo Ruiz] y vivo aquí
Monsieur [name Bernard] attend le train
Frau [name Schneider] kommt heute
Herr [name Fischer] ist krank
Mme [name Petit] a écrit
signed , [name Alice Cooper]
Prof . [name Hawking] said so
Dear Ms . [name Walker] , thanks
Señora [name Torres] compra pan
jane [email jane dot doe at example dot com]
write me : [email bob at mail dot example dot net] .
email [email carol ( at ) firm ( dot ) org] now
kontakt : [email dieter [ at ] haus [ dot ] de]
reach us at [email help at shop dot co] please
mail [email e.muster at post dot ch] , danke
escriba a [email pedro at casa dot es]
écrivez à [email luc [ at ] maison.fr]
my email is [email zoe at web dot example dot io]
contact [email office ( at ) site.com]
on 12 - 10 - 2019 the river was high
in the years 2010 - 2019 , no one came
see version 10 . 2 . 3 of the file
there were 1 , 234 , 567 people in 1999
the call came at 10 : 30 in the morning
phone sales fell by 12 % in 2020
he was at home at the time , on the dot
the passport office opens at 9
Dr . No is a film of 1962
it costs $ 1 299 . 99 or 1 199 €
order 4711 - 0815 was sent on 2019 - 10 - 12
the name of the river is long
call it a day at 5 pm
page 12 of 345 , table 6 . 7
el número de casas es 1200 en 2015
la tabla 4 , de 30 a 45 , no es nueva
der Name der Rose ist ein Buch von 1980
le nom de la ville est ancien
la maison no 45 est à vendre , 250000 francs
score 3 - 2 after 90 minutes , 45000 people
room 101 at the end , door 7
call me Ishmael
ISBN 978 - 3 - 16 - 148410 is a book
temperatures of 20 / 30 / 40 and 50
"""

# More sentences without personal data; they look like it.
NEAR_MISSES = """
{word} {word} . A . {Word} {word} {word}
{word} {word} {word} . Ä . {Word} {word} , {word}
{word} . È . È . {Word} {word} . Ó . La {word}
{word} {word} . {Word} , {word} {word}
{word} {word} {word} . {Word} , {word}
{word} . {Word} , {word} {word} . {Word} , {word} {word} {word} . {Word} , {word}
{word} , {word} {word} . {Word} {word} , {word} {word} . {Word} , {word} {word}
{Word} {word} . {Word} , {word} . {Word} {word} {word} . {Word} , {Word} {word} . {Word}
{word} {word} is . {Word} , {word} est . {Word} {word} , {word} on . {Word} , {word}
{word} {word} . {Word} . {word} {word} . {Word} , {word} . {word} : {Word} , {word}
since 03 - 05 - 1987 the {word}
31 - 12 - 2024 {word} {word}
{word} 2020 - 11 - 05 , {word}
am 24 . 12 . 1999 {word}
le 14 / 07 / 2002 {word}
on {number} - {number} - {number} the {word} was {word}
{word} from {number} to {number} , - {number} - {number}
{number} - {number} - {number} , {word}
{number} / {number} / {number} {word}
the call came at {number} : {number} in the {word}
call it a {word} at {number}
phone {word} fell by {number} % in {number}
the phone of the {word} is {word}
telephone {word} and fax {word}
Tel {word} {word}
my number of {word} is {number}
the number is {number}
a number of {number} {word}
número de {word} es {number} en {number}
la {word} no {number} , le {word} no {number}
passport {word} opens at {number}
the {word} is a passport to {word} {number}
tax {word} of {number} % , insurance {word} of {number}
tax number {word} , license {word} {number} . {number}
social {word} and security {word} in {number}
M . {word} {word} , m {word}
the name of the {word} is {word}
name {word} , name : {word}
Name {word} der {Word} ist {word} .
le nom de la {word} est {word}
dr . {word} prof . {word}
Don {word} , don {word} y doña {word}
dear {word} , Dear {word} {word}
signed by {word} {word} , customer {word} and patient {word}
named {word} {word} , called {word}
call me {word} , write to {word}
reach {word} at {number} , {word} on {number}
reach me at the {word} , contact us in {number}
mail {word} at the {word} . {Word} {word}
email {word} and mail at {number} {word}
{word} dot {word} , {word} at {word}
the dot at the {word} is {word}
www . {word} . com at {number}
{word} at {word} . {word}
order {number} - {number} was {word} in {number} - {number} - {number}
$ {number} {number} . {number} or {number} {number} €
ISBN {number} - {number} - {number} - {number}
Version {number} . {number} . {number} , v {number} . {number}
room {number} , door {number} , page {number} of {number}
score {number} - {number} after {number} minutes
unter {number} {word} , erreichbar in {number} Minuten
Nummer {number} von {number}
le numéro {number} de la {word}
Sr {word} , Sra {word} , sr . {word}
the {word} , Mr and Mrs , is {word}
"""

# Sentences without personal data; {word} and {number} are filled in.
OUTSIDE = """
the {word} of the {word} is in the {word}
The {word} was {word} and {word} , then it {word} .
It {word} in {number} and ended in {number} .
there were {number} of them , not {number} .
Version {number} . {number} of the {word} came out
see page {number} - {number} and table {number}
at the end of the {word} , dot by dot , it was done
we met at {word} in the {word}
In {number} , the {Word} of {Word} had {number} {word} .
{Word} {word} {word} {Word} , {word} {word} .
{Word} . {Word} {word} . {Word} {word} {word}
{word} # # # {word} % % % {word} & & &
{word} $ $ $ {word} * * * {word}
{word} | {word} | {number} | {word} .
| {number} | {number} | {number} |
( {number} ) {word} {word} ( {word} )
[ {number} ] {Word} {word}
{number} / {number} / {number}
{number} - {number} - {word}
token = " {hex} "
api_key : {hex}
password = {hex} ;
http : / / {word} . {word} . com / {word} / {number} . html
© {number} {Word} . All rights reserved .
Licensed under the {Word} License , Version {number} . {number}
la {word} de la {word} y el {word} no es {word} .
le {word} de la {word} et les {word} sont {word} .
der {word} und die {word} sind in der {word} .
El {Word} {word} en {number} .
{WORD} {WORD} ! ! {WORD} {word}
{Word}
{number}
{word} , {number} {word} , {number} % {word}
The number is {number} , the name of the {word} is {word} .
the phone was {word} and the fax was {word}
a passport is a {word} , an iban is a {word}
$ {number} . {number} or {number} , {number} {word}
{number} : {number} - {number} : {number} {word}
id {number} and no . {number} in the {word}
order {number} {number} {number} {word}
{word} {number} {word} {number} {word} {number}
the Mr and Mrs {word} of {word}
{word} , {word} at . {Word} {word} and {word}
{word} at at {word} . {Word} at at the {word} {word}
At at the {word} , at {word} at . At {word}
at . At at At at At . At {word} At at
{Word} . {Word} . {Word} . {Word} . {Word} . {Word} .
{Word} {Word} {Word} {Word} {Word} {Word} {Word} {Word}
{WORD} {WORD} NO . {WORD} {WORD} AT {WORD} . {WORD} AT
{word} no . {Word} {word} de no {word} . No {word} no
under the GNU {Word} {Word} License , version {number}
{word} . {Word} % % % {word} . # # # {Word} {word} . * * * {Word}
{word} at {number} , {word} no {number} . {Word}
by the name of {word} . {Word} {word} the number . {Word}
that reach of {word} . {Word} write {word} . {Word} call . {Word}
{WORD} " {hex} " ! ! {WORD} {hex} {WORD} ! !
the dr {word} , ms {word} . {Word} {word} mr {word}
"""

# What the outside sentences are filled with.
VALUES = {
    "word": ["é", "ê", "è", "ñ", "ö", "y", "es", "is", "on", "river", "the", "of", "then", "casa", "maison", "haus", "ingthere", "and", "que", "les", "keit", "ción", "number", "reader", "in", "über", "está", "élan", "a"],
    "Word": ["È", "Ä", "Ailement", "Nd", "Von", "Theant", "La", "Der", "Es", "The", "River", "Casa", "Haus", "Onthere", "Ouen", "Keit", "In", "Él", "Apache", "A"],
    "WORD": ["RIVER", "THE", "CASA", "MAISON", "IN", "A", "ONTHERE"],
    "number": ["1", "12", "365", "1987", "2024", "10", "45000", "7", "123456", "4736962573099581", "100", "99", "0", "8080", "31415926"],
    "hex": ["747 e 8 edd 6430861 f 24 c 6911 d 38 d 6", "a 9 f 3 b 2 c 4", "AKIA 7 Q 2 ZX 9", "deadbeef 00 ff 13"],
}


#: Kinds whose values have more forms come more often.
WEIGHT = {"phone": 2, "id": 1, "email": 3, "name": 1}
MARKS = list(".,;:!?%#$&*|\"()/-")


def formed(form: str, draw: random.Random) -> str:
    return "".join(draw.choice("0123456789") if c == "9" else draw.choice("ABCDEFGHKLMNPRSTXYZ") if c == "X" else c for c in form)


def value(kind: str, nth: int, draw: random.Random) -> str:
    """A value of that kind; forms come in turn, so that every cue meets several."""
    if kind in FORMS:
        forms = FORMS[kind].split("|")
        return formed(forms[nth % len(forms)], draw)
    if kind == "email":
        dot = DOT[nth % len(DOT)]
        # a bare full stop goes with a bracketed at only: "at home . then" is no address
        at = draw.choice(AT[:2] if dot == "." else AT)
        return f"{draw.choice(USERS)} {at} {f' {dot} '.join(draw.choice(HOSTS).split())}"
    return draw.choice(LAST) if nth % 3 == 0 else f"{draw.choice(FIRST)} {draw.choice(LAST)}"


def examples(each: int = 8, rounds: int = 5, background: int = 500) -> list[str]:
    """Marked sentences: every cue with `each` values, every template without data filled `rounds` times, values in turn."""
    draw, found = random.Random(0), []
    for kind, cues in CUED.items():
        for i, cue in enumerate(cues.split("|")):
            for n in range(each * WEIGHT[kind]):
                found.append(" ".join(f"{draw.choice(BEFORE)} {cue} [{kind} {value(kind, i + 5 * n, draw)}] {draw.choice(AFTER)}".split()))
    at = {k: 0 for k in VALUES}
    for line in [*OUTSIDE.strip().split("\n"), *NEAR_MISSES.strip().split("\n")]:
        for _ in range(rounds):
            parts = line.split("{")
            text = parts[0]
            for part in parts[1:]:
                kind, rest = part.split("}", 1)
                text += VALUES[kind][at[kind] % len(VALUES[kind])] + rest
                at[kind] += 1
            found.append(text)
    # words and marks in any order, as in lists, tables and damaged texts
    for _ in range(background):
        kinds = draw.choices(["word", "Word", "WORD", "number", "mark", "glued"], [8, 3, 1, 1, 3, 1], k=draw.randint(4, 14))
        found.append(" ".join(draw.choice(MARKS) if k == "mark" else " ".join(draw.choice(MARKS) * 3) if k == "glued" else draw.choice(VALUES[k]) for k in kinds))
    return found


def held_out() -> list[str]:
    return HELD_OUT.strip().split("\n")
