"""Sentences that were written apart from the lexicon, of both classes, in seven languages, the harmless ones close to abuse.

They came in two lists. At first sight 45 of 50 abusive and 2 of 50 harmless ones of the first were flagged; after
what that taught, 35 of 35 and 4 of 35 of the second. What is asserted is what holds after corrections for both.
"""

from siftmill.llm.abuse import THRESHOLD, automaton, measure

FIRST_ABUSIVE = """
You absolute cretin, read the protocol before you touch my samples.
Nobody respects you around here and nobody ever will.
I swear I will smash your teeth if you rename that column again.
Marek is such a spineless weasel, he hides behind the wiki.
Hope you get cancer for that commit.
Why don't you go hang yourself, Petra.
You're a brainless imbecile and your plots are fake.
This dimwit deleted the bucket, what an utter moron.
Do the world a favor and drink bleach.
Refugees are parasites that should be deported.
Muslims are criminals, get rid of all of them.
I hate all gays in this building.
Women belong in the kitchen, not in front of a spectrometer.
Those Belvonians are nothing but thieves and liars.
Kick that faggot out of the channel.
Show me your tits on the next call, sweetie.
I can't stop thinking about your naked body, come over tonight.
I'd love to bend you over the fume hood.
She gave him a blowjob in the freezer room, his cock was everywhere.
Your mother should be ashamed she raised such trash.
We would all be better off without you, Hannes.
Go to hell, you lying piece of garbage.
You'll end up in a body bag, little man.
Everyone laughs at you behind your back, you clown.
How dense and stupid can you be?
f u c k  y o u, Ivo
y0u are a w0rthless m0r0n
Du bist so ein Vollidiot, Jens.
Ich bringe dich um, wenn du das noch mal machst.
Ausländer sind Ungeziefer.
Zeig mir deine Titten, Süße.
Eres una inútil y todos lo saben.
Te voy a partir la cara, imbécil.
Los gitanos son ladrones.
Quiero follarte esta noche en la oficina.
Espèce d'abruti, tu as effacé les données.
Je vais te casser la gueule demain.
Les juifs sont des parasites.
J'ai envie de te baiser sur la paillasse.
Você é um idiota completo.
Vou te matar, seu desgraçado.
Os negros são inferiores.
Manda fotos dos teus peitos.
你是个白痴，什么都不会。
我要杀了你。
黑人都是垃圾。
今晚我想跟你做爱。
お前は本当にバカだ。
外国人は国へ帰れ、犯罪者ばかりだ。
おっぱい見せてよ。
""".strip().splitlines()

FIRST_HARMLESS = """
You can kill the idiot process now, he is a saint.
The refugees clinic treats plague and disease.
I was such an idiot, I forgot the units again.
This damn scheduler is a piece of shit today.
What the fuck happened to the queue?
Rats were dosed at 5 mg/kg and animals recovered.
The parasite is killed by the compound within an hour.
Women and men were recruited in equal numbers.
Migrants in the cohort had a lower incidence of disease.
Kill the child process before you start the master.
Breast cancer cells were stained and fixed.
The naked mole rat genome is in the folder.
You are right, the dumb terminal was the reason.
Please do not insult others, insults are removed.
Sex was used as a covariate together with age.
He said the script is stupid slow on large files.
I would love to see you at the meeting tonight.
We will miss you, good luck in Lisbon!
Everybody here likes you and your plots.
The strip is placed under the wet filter and sucked dry.
Would you send me a picture of your gel?
Your body weight tables are attached.
The old pump is a total failure, replace it.
Never trust a single docking score.
Get rid of all waste in the red container.
The immigrants survey has been cleaned of all duplicates.
You beast, forty runs in a night!
Jewish and Muslim holidays are marked in the calendar.
That joke about the donkey was good.
I will break your changes into two commits.
If I see you at lunch I will bring your pipette.
The native ligand is bound tightly, hot spots are in red.
Hit compounds that beat you to the punch are rare.
Der Prozess ist tot, ich Idiot habe ihn beendet.
Brustkrebs ist häufig bei Frauen über fünfzig.
Verdammt, die Warteschlange ist schon wieder voll.
Soy un idiota, olvidé el archivo.
El cáncer de mama afecta a mujeres y hombres.
Mata el proceso y vuelve a empezar.
Putain, le serveur est encore tombé.
Les femmes enceintes ont été exclues de l'étude.
Quel idiot je suis, j'ai perdu la clé.
O câncer de mama é comum em mulheres idosas.
Que merda de fila, travou de novo.
Mate o processo antes de reiniciar.
我真是个白痴，又忘了保存。
乳腺癌患者中女人占多数。
杀掉进程然后重启。
プロセスを殺して再起動してください。
私はバカだ、また忘れた。
""".strip().splitlines()

SECOND_ABUSIVE = """
What a clueless jerk you are, Tom, go back to school you dimwit.
Anna is a lying bitch and I will tell everybody.
If you open your mouth again I am going to punch you.
You will end up in a wheelchair, I promise.
You deserve to die for what you did.
Nobody would miss you if you quit, you pathetic loser.
Only an idiot would trust her, she is a total cretin.
Kill yourself, nobody cares about you.
Shut your trap, nobody wants you here.
These Turvanians are dirty rats, deport them.
No wonder the screen failed, they let women run the robot.
Jews are vermin.
Disabled people are a plague and should be locked away.
The gypsies always lie and steal, never trust gypsies.
Get out, you filthy foreigner, go back where you came from.
I want to fuck you in the archive tonight.
Send me pics of your pussy, please.
He keeps staring at her tits and moaning about how he wants to shag you.
Wanna see my cock? I am so horny for you.
Halt dein Maul, du Arschloch.
Du bist eine Schande, niemand mag dich.
Frauen sind minderwertig und gehören an den Herd.
Ich will dich ficken.
Vete al infierno, hijo de puta.
Ojalá te mueras pronto.
Los judíos son una plaga.
Ta gueule, connard.
Tu es une salope.
Les noirs sont tous des voleurs.
Vai se foder, seu idiota.
Você é um lixo.
去死吧，没人喜欢你。
女人都是蠢货，滚出实验室。
黙れ、このクズ。
俺がお前を殺す。
""".strip().splitlines()

SECOND_HARMLESS = """
Only an idealist would trust that score.
I am going to punch holes for the binder.
You will end up in a queue, be patient.
Nobody would notice if you reran it tonight.
They let women and men choose the time slot.
The immigrants clinic will get rid of all paper forms.
The rats are animals of the same strain.
Plague is caused by bacteria that infect fleas and rodents.
Turtles are slow, technicians are not.
I want to see you in the archive tonight.
Send me pictures of your plates, please.
The mother liquor was ashamedly cloudy.
You are absolutely right about the parser.
He is a fan of stupid jokes.
My stupid script killed the wrong job.
Show me your results on the next call.
A bitch was dosed with 2 mg and blood was taken.
The cock is closed before the pump starts.
Nude mice bearing tumours were randomised.
Remarks of a sexual kind are forbidden in this channel.
The word moron is blocked by our filter.
We hate to see you go.
That is a killer plot, you monster!
Ich bringe dich um acht Uhr zum Bahnhof.
Die Frauen im Labor sind heute früher da.
So dumm, ich habe den Schlüssel vergessen.
Qué asco de cola, otra vez llena.
Las mujeres del estudio son mayores de edad.
Je suis nul en statistiques.
Les rats sont nourris deux fois par jour.
Os ratos são alimentados duas vezes.
Sou burro, apaguei a tabela.
这个队列真是垃圾。
老鼠被分成三组。
この装置は古くて使えない。
""".strip().splitlines()


def flagged(texts):
    return [t for t in texts if measure(t, automaton())[0] >= THRESHOLD]


def test_recall_and_precision():
    hits, wrong = flagged(FIRST_ABUSIVE + SECOND_ABUSIVE), flagged(FIRST_HARMLESS + SECOND_HARMLESS)
    assert len(hits) / len(FIRST_ABUSIVE + SECOND_ABUSIVE) >= 0.94
    assert len(hits) / (len(hits) + len(wrong)) >= 0.97
